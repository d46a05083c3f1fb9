"""Incremental runs over the event table and the postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmart.catalog.jobs import SILVER, SPLIT, TS
from jobmart.catalog.registry import Inputs, query
from jobmart.functions import cleaning
from jobmart.operators import timerange
from jobmart.streaming import incremental


@query("events_hourly_tumbling", """
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def events_hourly_tumbling(src: Inputs):
    return incremental.hourly_counts(src.table("events"), "ts", "event_type")


# The last hours stay open until later events push the watermark past them; they are added on request.
@query("stream_hourly_counts", """
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_hourly_counts(src: Inputs):
    stream = incremental.landing_stream(
        src.spark, src.sf_dir, src.table("events").schema, files="events.parquet"
    )
    timed = incremental.with_event_time(stream, "ts", "10 minutes")
    out = src.work_dir("hourly")
    counts = incremental.run_append(
        incremental.hourly_counts(timed, "ts", "event_type"), out, f"{out}-checkpoint"
    )
    closed = counts.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    return incremental.with_open_hours(closed, src.table("events"), "ts", "event_type")


def _landed_in_two_runs(src: Inputs) -> str:
    """The postings as two hourly loads, the later half landed first."""
    raw, path = src.fixture("jobs_raw"), src.work_dir("stream_landing")
    cut = timerange.instant(raw, TS, SPLIT)
    raw.filter(F.col(TS) >= cut).write.parquet(path)
    raw.filter(F.col(TS) < cut).write.mode("append").parquet(path)
    return path


@query("stream_upsert_jobs", f"SELECT {SILVER} FROM jobs_silver")
def stream_upsert_jobs(src: Inputs):
    landing, out = _landed_in_two_runs(src), src.work_dir("stream_jobs")
    stream = incremental.landing_stream(
        src.spark, landing, src.fixture("jobs_raw").schema, files_per_batch=1
    )
    incremental.start_job_upserts(stream, out, f"{out}-checkpoint").awaitTermination()
    return incremental.current_jobs(src.spark, out)


# The watermark spans the whole retention, so each job passes once, however its id is written.
@query("stream_dedup", """
SELECT DISTINCT TRY_CAST(JobId AS BIGINT) AS JobId FROM jobs_raw WHERE TRY_CAST(JobId AS BIGINT) IS NOT NULL""")
def stream_dedup(src: Inputs):
    landing, out = _landed_in_two_runs(src), src.work_dir("stream_ids")
    stream = incremental.landing_stream(src.spark, landing, src.fixture("jobs_raw").schema, files_per_batch=1)
    numbered = stream.select(cleaning.to_id(F.col("JobId")).alias("JobId"), TS).filter("JobId IS NOT NULL")
    timed = incremental.with_event_time(numbered, TS, "31 days")
    seen = incremental.first_sightings(timed, ["JobId"]).select("JobId")
    return incremental.run_append(seen, out, f"{out}-checkpoint")
