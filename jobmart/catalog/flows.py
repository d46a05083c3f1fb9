"""Whole runs of the flows over named tables."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from jobmart.catalog.enrich import stand_in_model
from jobmart.catalog.jobs import HOUR_AS_OF, SPLIT, TS, TWO_RUNS, TWO_RUNS_SQL, _first
from jobmart.catalog.pages import META_SQL, POST_SQL
from jobmart.catalog.population import PERIOD, SEXES
from jobmart.catalog.registry import Inputs, query
from jobmart.operators import enrichment, timerange
from jobmart.plans import population_flow
from jobmart.plans.lake import Lake, run_jobs_hour, run_population_month, silver_jobs
from jobmart.schemas import POPULATION_SILVER
from jobmart.sources import tables


def _lake(src: Inputs) -> Lake:
    return Lake(src.spark, src.work_dir("lake"), f"lake_{uuid.uuid4().hex}_")


@query("hourly_flow_jobs", TWO_RUNS_SQL)
def hourly_flow_jobs(src: Inputs):
    lake, raw = _lake(src), src.fixture("jobs_raw")
    cut = timerange.instant(raw, TS, SPLIT)
    first, second = TWO_RUNS
    run_jobs_hour(lake, raw.filter(F.col(TS) < cut), first)
    run_jobs_hour(lake, raw.filter(F.col(TS) >= cut), second)
    return silver_jobs(lake, second)


class _Broken(Exception):
    """A run that breaks off."""


@query("hourly_flow_retry", TWO_RUNS_SQL)
def hourly_flow_retry(src: Inputs):
    """The second run fails after bronze has lost its old days, and is repeated."""
    lake, raw = _lake(src), src.fixture("jobs_raw")
    cut = timerange.instant(raw, TS, SPLIT)
    first, second = TWO_RUNS
    run_jobs_hour(lake, raw.filter(F.col(TS) < cut), first)

    class FailsAfterExpiry(Lake):
        def table(self, table: str):
            if table == "silver.jobs":
                raise _Broken
            return super().table(table)

    later = raw.filter(F.col(TS) >= cut)
    try:
        run_jobs_hour(FailsAfterExpiry(src.spark, lake.root, lake.prefix), later, second)
    except _Broken:
        pass
    run_jobs_hour(lake, later, second)
    return silver_jobs(lake, second)


@query("enrich_failures_after_runs", """
SELECT JobId, CAST(2 AS INTEGER) AS attempts, 'content rejected' AS error
FROM jobs_silver
WHERE length(JobDescription) % 7 = 0 AND ExtractionDatetime > TIMESTAMP '2023-12-31 00:30:00'""")
def enrich_failures_after_runs(src: Inputs):
    """Two runs an hour apart: what the model refuses is asked twice, what it answers once."""
    lake, raw = _lake(src), src.fixture("jobs_raw")
    run_jobs_hour(lake, raw, HOUR_AS_OF, ask=stand_in_model())
    run_jobs_hour(lake, raw.limit(0), HOUR_AS_OF + timedelta(hours=1), ask=stand_in_model())
    return lake.table("silver.enrich_failures").drop("last_try")


def _one_run(src: Inputs) -> Lake:
    lake = _lake(src)
    run_jobs_hour(
        lake, src.fixture("jobs_raw"), HOUR_AS_OF, src.fixture("company_pages"), stand_in_model()
    )
    return lake


@query("hourly_flow_followers", f"""
SELECT * FROM (
  SELECT concat('https://jobs.example/c/', id) AS url, coalesce({POST_SQL}, {META_SQL})
    AS Nbr_of_followers, TIMESTAMP '2024-01-30 23:30:00' AS extraction_time FROM follower_text)
WHERE Nbr_of_followers IS NOT NULL AND url IN (
  SELECT CompanyLinkedinUrl FROM jobs_raw
  WHERE date_trunc('hour', ExtractionDatetime) = TIMESTAMP '2024-01-30 23:00:00')""")
def hourly_flow_followers(src: Inputs):
    return _one_run(src).table("silver.followers")


@query("hourly_flow_enriched", """
SELECT JobId, 'words2' AS Tools, CAST(NULL AS VARCHAR) AS Requirements, CAST(NULL AS VARCHAR) AS Offer,
  'Remote' AS WorkType
FROM jobs_silver
WHERE length(JobDescription) % 7 <> 0 AND ExtractionDatetime > TIMESTAMP '2023-12-30 23:30:00'""")
def hourly_flow_enriched(src: Inputs):
    return enrichment.explode_wide(_one_run(src).table("silver.enriched"))


@query("hourly_flow_enriched_two_runs", f"""
SELECT JobId, 'words2' AS Tools, CAST(NULL AS VARCHAR) AS Requirements, CAST(NULL AS VARCHAR) AS Offer, 'Remote' AS WorkType
FROM ({TWO_RUNS_SQL}) now LEFT JOIN (
  SELECT JobId, JobDescription AS before FROM {_first("SeenAt < TIMESTAMP '2024-01-15'")}) USING (JobId)
WHERE length(JobDescription) % 7 <> 0 OR length(before) % 7 <> 0""")
def hourly_flow_enriched_two_runs(src: Inputs):
    """Jobs that retention takes between the runs lose their enriched rows; only their days are touched."""
    lake, raw = _lake(src), src.fixture("jobs_raw")
    cut = timerange.instant(raw, TS, SPLIT)
    first, second = TWO_RUNS
    run_jobs_hour(lake, raw.filter(F.col(TS) < cut), first, ask=stand_in_model())
    run_jobs_hour(lake, raw.filter(F.col(TS) >= cut), second, ask=stand_in_model())
    return enrichment.explode_wide(lake.table("silver.enriched"))


_POPULATION = "SELECT City, MenPopulation, WomenPopulation, TotalPopulation FROM population_silver"


@query("monthly_flow_population", _POPULATION)
def monthly_flow_population(src: Inputs):
    lake = _lake(src)
    run_population_month(lake, src.fixture("population_raw"), None, SEXES, PERIOD)
    return lake.table("silver.population")


@query("population_refresh", _POPULATION)
def population_refresh(src: Inputs):
    path = src.work_dir("population")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    for _ in range(2):
        tables.ensure_table(src.spark, name, POPULATION_SILVER, path)
    feed = src.fixture("population_raw")
    tables.refresh_table(population_flow.population_silver(feed, None, SEXES, "2024M07"), name)
    return tables.refresh_table(population_flow.population_silver(feed, None, SEXES, PERIOD), name)
