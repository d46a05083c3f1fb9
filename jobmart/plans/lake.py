"""The two flows over named tables: each run reads the layers, computes, and writes each table once.

Tables are Parquet files registered in the session's catalog. Bronze postings are appended by day of
sighting. Silver jobs are kept by day of publication, and a run rewrites only the days whose jobs
changed. Enriched jobs are kept by the same day, with their lists in one row; ``operators.enrichment`` turns them into the wide or
long form on read. The other tables are replaced by writing a new version beside the old one and pointing the
name at it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType

from jobmart.functions import cleaning
from jobmart.operators import checks, enrichment, merge, timerange
from jobmart.plans import extraction, jobs_flow
from jobmart.plans.population_flow import population_silver
from jobmart.schemas import (
    ENRICH_FAILURES, ENRICHED_LISTS, FOLLOWERS, JOB_BRONZE, JOB_SILVER, POPULATION_SILVER, REJECTS,
)
from jobmart.sources import tables

DAY = "extraction_date"
JOB_DAY = "job_date"
UNDATED = date(9999, 12, 31)
AHEAD = timedelta(days=30)

SCHEMAS = {
    "bronze.jobs": StructType([*JOB_BRONZE, StructField(DAY, DateType())]),
    "bronze.rejects": REJECTS,
    "bronze.followers": FOLLOWERS,
    "bronze.follower_history": FOLLOWERS,
    "silver.jobs": StructType([*JOB_SILVER, StructField(jobs_flow.SEEN, TimestampNTZType()), StructField(JOB_DAY, DateType())]),
    "silver.followers": FOLLOWERS,
    "silver.enriched": StructType([*ENRICHED_LISTS, StructField(JOB_DAY, DateType())]),
    "silver.enrich_failures": ENRICH_FAILURES,
    "silver.population": POPULATION_SILVER,
}


PARTITIONS = {"bronze.jobs": DAY, "silver.jobs": JOB_DAY, "silver.enriched": JOB_DAY}


class Lake:
    """Bronze and silver tables under one folder; ``prefix`` keeps several lakes apart in one catalog."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        for layer in ("bronze", "silver"):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{self.root}/{layer}'")
        for table, schema in SCHEMAS.items():
            tables.ensure_table(
                spark, self.name(table), schema, self.new_path(table), PARTITIONS.get(table)
            )

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def table(self, table: str) -> DataFrame:
        """The rows of a table. The day by which enriched rows are kept says when to drop them, and is left out."""
        stored = self.stored(table)
        return stored.drop(JOB_DAY) if table == "silver.enriched" else stored

    def stored(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def new_path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}/{uuid.uuid4().hex}"

    def replace(self, table: str, rows: DataFrame) -> DataFrame:
        """The new version of a table; a NULL in a required column fails the run before the swap."""
        schema = SCHEMAS[table]
        checked = checks.require_not_null(rows, [f.name for f in schema if not f.nullable])
        ordered = checked.select(*schema.fieldNames())
        return tables.swap_table(ordered, self.name(table), self.new_path(table))


def update_jobs(lake: Lake, landed: DataFrame, bronze: DataFrame, as_of: datetime) -> DataFrame:
    """Bring silver up to the batch and to what retention took from bronze, then retention by silver time.

    Only days that lose or gain a changed row are rewritten; which ones those are, a list of days, is
    all that comes to the driver. A publish time more than ``AHEAD`` after ``as_of`` is none (some feeds
    date postings ahead), so the number of days is bounded.
    """
    silver = lake.table("silver.jobs")
    found = jobs_flow.changed_jobs(silver.drop(JOB_DAY), landed, bronze, as_of)
    latest = timerange.instant(found, jobs_flow.TIME, as_of + AHEAD)
    time = F.when(F.col(jobs_flow.TIME) > latest, F.col(jobs_flow.SEEN)).otherwise(F.col(jobs_flow.TIME))
    found = found.withColumn(jobs_flow.TIME, time)
    job_day = F.coalesce(F.to_date(jobs_flow.TIME), F.lit(UNDATED))
    found = tables.land(found.withColumn(JOB_DAY, job_day), lake.new_path("runs.found"))
    kept_found = timerange.retain(found, jobs_flow.TIME, as_of)
    left_by = silver.join(found.select("JobId"), "JobId", "left_semi")
    changed = left_by.select(JOB_DAY).unionByName(kept_found.select(JOB_DAY)).distinct()
    days = sorted(row[0] for row in changed.toLocalIterator())
    if days:
        stay = merge.not_yet_in(silver.filter(F.col(JOB_DAY).isin(days)), found, jobs_flow.KEY)
        rows = stay.unionByName(kept_found).select(*silver.columns)
        checked = checks.require_not_null(rows, jobs_flow.KEY)
        name, path = lake.name("silver.jobs"), lake.new_path("silver.jobs")
        tables.replace_days(checked, name, path, JOB_DAY, days)
    tables.expire_days(lake.spark, lake.name("silver.jobs"), as_of, day=JOB_DAY, root=lake.root)
    return silver_jobs(lake, as_of)


def silver_jobs(lake: Lake, as_of: datetime) -> DataFrame:
    """Silver jobs as of a run: the day on the edge of retention is trimmed on read."""
    held = timerange.retain(lake.table("silver.jobs"), jobs_flow.TIME, as_of)
    return held.drop(JOB_DAY, jobs_flow.SEEN)


def update_enriched(
    lake: Lake, silver: DataFrame, as_of: datetime, ask: Callable[[str], str] | None, calls: dict | None
) -> None:
    """Ask for the backlog, add what was answered, remember what failed, drop rows whose job is gone.

    Nothing is written that does not change: answers are appended to the day of their job, and of the days
    whose jobs are gone a part is rewritten or, mostly, a whole one dropped. A list of days is all that comes to the driver.
    """
    enriched, failures = lake.table("silver.enriched"), lake.table("silver.enrich_failures")
    if ask is not None:
        todo = enrichment.not_given_up(jobs_flow.backlog(silver, enriched), failures, as_of)
        called = enrichment.call_model_once(todo, ask, **(calls or {}))
        answers = tables.land(called, lake.new_path("runs.answers"))
        rows = enrichment.to_lists(enrichment.parse_answers(answers.select("JobId", "response")))
        if not rows.isEmpty():
            # The backlog holds no job that has a row, so these are new.
            dated = rows.join(lake.stored("silver.jobs").select("JobId", JOB_DAY), "JobId")
            tables.append_to_table(dated, lake.name("silver.enriched"), JOB_DAY)
        failed = enrichment.failures_after(failures, answers, as_of)
        if not answers.isEmpty():
            lake.replace("silver.enrich_failures", failed)
    stored = lake.stored("silver.enriched")
    days = sorted(row[0] for row in merge.not_yet_in(stored, silver, jobs_flow.KEY).select(JOB_DAY).distinct().toLocalIterator())
    if days:
        stay = merge.prune_orphans(stored.filter(F.col(JOB_DAY).isin(days)), silver, jobs_flow.KEY)
        name, path = lake.name("silver.enriched"), lake.new_path("silver.enriched")
        before = tables.partition_locations(lake.spark, name)
        tables.replace_days(stay.select(*stored.columns), name, path, JOB_DAY, days)
        left = {row.partition for row in lake.spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator()}
        for gone in before.keys() - left:
            tables.delete_folder(lake.spark, before[gone], lake.root)
    failures = lake.table("silver.enrich_failures")
    if not merge.orphan_keys(failures, silver, jobs_flow.KEY).isEmpty():
        lake.replace("silver.enrich_failures", merge.prune_orphans(failures, silver, jobs_flow.KEY))


def run_jobs_hour(
    lake: Lake,
    landed: DataFrame,
    as_of: datetime,
    company_pages: DataFrame | None = None,
    ask: Callable[[str], str] | None = None,
    calls: dict | None = None,
    rejects: DataFrame | None = None,
) -> None:
    """One hourly run: landed postings in, all job tables brought up to ``as_of``.

    A run that failed may be repeated, at whatever step it failed: postings appended twice are one job
    in silver, and what retention took is read off silver.

    ``company_pages`` are ``(url, html)`` of companies that were looked up, with ``fetched`` if the
    pages of several lookups come together; only those of the current hour's postings count. ``ask``
    answers a description with JSON; without it nothing is enriched. ``calls`` are further arguments of
    ``enrichment.call_model_once``. ``rejects`` (line) are landed lines that could not be read; they are kept.
    """
    if rejects is not None and not rejects.isEmpty():
        seen_at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        tables.append_to_table(rejects.select("line", seen_at.alias("seen")), lake.name("bronze.rejects"))
    tables.append_to_table(tables.with_day(landed, jobs_flow.TIME, DAY), lake.name("bronze.jobs"), DAY)
    tables.expire_days(lake.spark, lake.name("bronze.jobs"), as_of, day=DAY, root=lake.root)
    bronze = timerange.retain(lake.table("bronze.jobs"), jobs_flow.TIME, as_of)

    if company_pages is not None:
        fresh = jobs_flow.fresh_company_urls(bronze, as_of, DAY)
        seen = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        if "fetched" in company_pages.columns:
            seen = F.coalesce(F.col("fetched").cast("timestamp_ntz"), seen)
        pages = company_pages.withColumn("url", cleaning.plain_url(F.col("url")))
        batch = extraction.company_followers(pages.join(fresh, "url", "left_semi"), seen)
        batch = tables.land(batch, lake.new_path("runs.followers"))
        if not batch.isEmpty():
            # Every lookup stays, for what was known at a time; a repeated run adds equal rows, which change nothing.
            tables.append_to_table(batch, lake.name("bronze.follower_history"))
            for table in ("bronze.followers", "silver.followers"):
                lake.replace(table, jobs_flow.followers_after(lake.table(table), batch))
    silver = update_jobs(lake, landed, bronze, as_of)
    update_enriched(lake, silver, as_of, ask, calls)


def vacuum(lake: Lake) -> list[str]:
    """Delete files under the lake's root that no table or partition of it points at; returns the folders.

    Superseded versions and the ``runs`` folder go. Call it when no run and no reader is active.
    """
    used = set()
    for table in SCHEMAS:
        used.add(tables.table_location(lake.spark, lake.name(table)))
        if table in PARTITIONS:
            used.update(tables.partition_locations(lake.spark, lake.name(table)).values())
    gone = []
    for table in [*SCHEMAS, "runs.landed", "runs.found", "runs.answers", "runs.followers"]:
        folder = f"{lake.root}/{table.replace('.', '/')}"
        for version in tables.list_folders(lake.spark, folder):
            if not any(u == version or u.startswith(f"{version}/") for u in used):
                tables.delete_folder(lake.spark, version, lake.root)
                gone.append(version)
            elif version not in used:  # some of its days are still pointed at
                for day in tables.list_folders(lake.spark, version):
                    if day not in used:
                        tables.delete_folder(lake.spark, day, lake.root)
                        gone.append(day)
    return gone


def run_population_month(
    lake: Lake, feed: DataFrame, codes: DataFrame | None, sexes: list[str], period: str
) -> None:
    """One monthly run: the feed's month replaces the population table."""
    lake.replace("silver.population", population_silver(feed, codes, sexes, period))
