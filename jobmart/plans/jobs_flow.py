"""The hourly flow: bronze postings to silver jobs, followers and enriched rows.

Step order: append, bronze retention, follower lookup of fresh companies, clean + dedup + upsert,
silver retention, enrichment backlog, insert-only merge, orphan prune. Every function returns the new
table as a DataFrame; the caller writes each table once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions import cleaning
from jobmart.operators import dedup, enrichment, lookup, merge, timerange
from jobmart.schemas import JOB_SILVER
from jobmart.sources.tables import union_evolving

KEY = ["JobId"]
SEEN, TIME = "SeenAt", "ExtractionDatetime"


def _seen(bronze: DataFrame) -> tuple[Column, str]:
    """When a posting was seen, and the type of that."""
    time_type = bronze.schema[TIME].dataType.simpleString()
    if time_type == "string":
        return F.col(TIME).try_cast("timestamp_ntz"), "timestamp_ntz"
    return F.col(TIME), time_type


def clean_jobs(bronze: DataFrame) -> DataFrame:
    """Silver columns plus ``SeenAt``, the bronze time that first-seen dedup orders by.

    The id becomes a number before anything groups by it, so ``'7'`` and ``'007'`` are one job.
    ``publishdatetime`` is optional in the feed.
    """
    seen, time_type = _seen(bronze)
    published: Column = F.lit(None).cast("string")
    if "publishdatetime" in bronze.columns:
        published = F.col("publishdatetime")
    changed = {
        "JobId": cleaning.to_id(F.col("JobId")),
        "CompanyName": cleaning.sentinel_to_null(F.col("CompanyName")),
        "CompanyLinkedinUrl": cleaning.plain_url(cleaning.sentinel_to_null(F.col("CompanyLinkedinUrl"))),
        "City": cleaning.city_of(F.col("Location")),
        "NbrOfApplicants": cleaning.applicants_of(F.col("NbrOfApplicants")),
        TIME: cleaning.published_or(published, seen, time_type),
    }
    return bronze.select(
        *(changed.get(f.name, F.col(f.name)).alias(f.name) for f in JOB_SILVER), seen.alias(SEEN)
    )


def sightings(bronze: DataFrame) -> DataFrame:
    """Cleaned postings that have an id, with ``SeenAt``."""
    return clean_jobs(bronze).filter(F.col("JobId").isNotNull())


def edge_sightings(bronze: DataFrame, keep: str = "first") -> DataFrame:
    """The sightings that may be a job's first (or last): those at its earliest time. Only these are cleaned."""
    numbered = bronze.withColumn("JobId", cleaning.to_id(F.col("JobId"))).filter(F.col("JobId").isNotNull())
    return sightings(dedup.candidates(numbered, KEY, _seen(bronze)[0], keep))


def one_per_job(bronze: DataFrame, keep: str = "first") -> DataFrame:
    """Cleaned postings, one row per job: the first sighting still held in bronze."""
    return dedup.keep_one(edge_sightings(bronze, keep), KEY, SEEN, keep).drop(SEEN)


def lost_jobs(silver: DataFrame, as_of: datetime) -> DataFrame:
    """Ids of silver jobs whose sighting (``SeenAt``) has left bronze by retention.

    Silver says so itself, whatever bronze still holds: a run that failed after its bronze retention
    finds the same ids when it is repeated.
    """
    return timerange.expired(silver, SEEN, as_of).select("JobId")


def changed_jobs(silver: DataFrame, landed: DataFrame, bronze: DataFrame, as_of: datetime) -> DataFrame:
    """Rows with ``SeenAt`` that are new or differ from silver after a batch and bronze retention.

    A job's row is its first sighting. Silver keeps when that was, so a later sighting changes
    nothing, and only jobs that lost theirs are looked up in bronze: ``landed`` and silver's own rows
    are all that the others need.
    """
    lost = lost_jobs(silver, as_of)
    older = edge_sightings(lookup_jobs(bronze, lost))
    fresh = edge_sightings(timerange.retain(landed, TIME, as_of))
    found = dedup.keep_one(fresh.unionByName(older), KEY, SEEN)
    held = lookup.with_key(silver, found, KEY).join(lost, KEY, "left_anti").select(*found.columns)
    pool = found.withColumn("_new", F.lit(True)).unionByName(held.withColumn("_new", F.lit(False)))
    # Equal rows are settled by the last column, for the row that silver holds.
    first = dedup.keep_one(pool, KEY, SEEN)
    return first.filter("_new").drop("_new")


def fresh_company_urls(bronze: DataFrame, as_of: datetime, day: str | None = None) -> DataFrame:
    """Company pages to look up: those of postings seen in the current hour."""
    return (
        timerange.in_hour(bronze, TIME, as_of, day)
        .filter(F.col("CompanyLinkedinUrl").isNotNull() & (F.col("CompanyLinkedinUrl") != ""))
        .select(cleaning.plain_url(F.col("CompanyLinkedinUrl")).alias("url"))
        .distinct()
    )


def bronze_after(bronze: DataFrame, landed: DataFrame, as_of: datetime) -> DataFrame:
    """Append with schema evolution, then retention."""
    return timerange.retain(union_evolving(bronze, landed), TIME, as_of)


def lookup_jobs(bronze: DataFrame, jobs: DataFrame) -> DataFrame:
    """Bronze rows of the given job ids, whatever form the id has in bronze."""
    numbered = bronze.withColumn("_job", cleaning.to_id(F.col("JobId")))
    wanted = jobs.select(F.col("JobId").alias("_job"))
    return lookup.with_key(numbered, wanted, ["_job"]).drop("_job")


def silver_jobs_after(silver: DataFrame, bronze: DataFrame, as_of: datetime) -> DataFrame:
    """Upsert the first sightings of all of bronze, then retention by silver time."""
    return timerange.retain(merge.upsert(silver, one_per_job(bronze), KEY), TIME, as_of)


def followers_after(followers: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert a follower batch by url. Rows without a count are no news; of several pages of one
    company the last one counts, so a batch has one row per url."""
    news = batch.filter(F.col("Nbr_of_followers").isNotNull()).select(*followers.columns)
    return merge.upsert(followers, dedup.keep_one(news, ["url"], "extraction_time", "last"), ["url"])


def backlog(silver: DataFrame, enriched: DataFrame) -> DataFrame:
    """Jobs without an enriched row."""
    return merge.not_yet_in(silver.select("JobId", "JobDescription"), enriched, KEY)


def enriched_after(
    enriched: DataFrame, answers: DataFrame, silver: DataFrame, wide: bool = False
) -> DataFrame:
    """Insert what newly answered jobs hold, then drop rows whose job is gone.

    ``answers`` are ``(JobId, response)``; answers that did not parse stay out, so their jobs are
    asked again. The table keeps the lists, one row per job, unless it is in the ``wide`` form.
    """
    parsed = enrichment.parse_answers(answers.select("JobId", "response"))
    rows = enrichment.to_wide(parsed) if wide else enrichment.to_lists(parsed)
    return merge.prune_orphans(merge.insert_only(enriched, rows, KEY), silver, KEY)
