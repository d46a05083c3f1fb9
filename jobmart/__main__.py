"""Run one flow: ``python -m jobmart jobs-hour …`` or ``population-month …``.

Session settings, the table catalog included, come from spark-submit or the environment.
"""

from __future__ import annotations

import argparse
import importlib
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from jobmart.operators.population import SEX_COLUMNS
from jobmart.plans.lake import Lake, run_jobs_hour, run_population_month
from jobmart.schemas import JOB_LANDING
from jobmart.session import build_session
from jobmart.sources import readers, tables


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="jobmart")
    flows = parser.add_subparsers(dest="flow", required=True)

    jobs = flows.add_parser("jobs-hour", help="landed postings into all job tables")
    jobs.add_argument("--landing", required=True, help="folder of landed postings, JSON lines")
    jobs.add_argument("--pages", help="folder of company pages (url, html), Parquet")
    jobs.add_argument("--call-tasks", type=int, help="tasks that call the model; default is shuffle partitions")
    jobs.add_argument("--calls-in-flight", type=int, default=4, help="calls under way per task")
    jobs.add_argument("--ask", help="module:function that answers a description with JSON")
    jobs.add_argument(
        "--as-of", type=datetime.fromisoformat, help="run time, UTC without zone; default is now"
    )
    month = flows.add_parser("population-month", help="population feed into the population table")
    month.add_argument("--feed", required=True, help="folder of the feed, CSV")
    month.add_argument("--period", required=True, help="month, like 2024M08")
    month.add_argument("--codes", help="folder of a Parquet table with the wanted codes")
    for flow in (jobs, month):
        flow.add_argument("--root", required=True, help="folder of the lake's tables")
        flow.add_argument("--prefix", default="", help="put before the schema names")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    if spark is None:
        spark = build_session("jobmart")
        if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
            # The lake's tables would be gone with this process, and the next run would begin empty.
            raise SystemExit("a table catalog that outlives the run is needed: spark.sql.catalogImplementation")
    lake = Lake(spark, args.root, args.prefix)
    if args.flow == "population-month":
        feed = readers.read_population_csv(spark, args.feed, [args.period])
        codes = spark.read.parquet(args.codes) if args.codes else None
        run_population_month(lake, feed, codes, list(SEX_COLUMNS), args.period)
        return
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    ask = None
    if args.ask:
        module, function = args.ask.split(":")
        ask = getattr(importlib.import_module(module), function)
    noted = tables.land(readers.read_rescued(spark, args.landing, JOB_LANDING), lake.new_path("runs.landed"))
    landed, rejects = readers.readable(readers.with_new_columns(noted)), readers.rejected(noted)
    pages = spark.read.parquet(args.pages) if args.pages else None
    calls = {"partitions": args.call_tasks, "in_flight": args.calls_in_flight}
    run_jobs_hour(lake, landed, as_of, pages, ask, calls, rejects)


if __name__ == "__main__":
    main()
