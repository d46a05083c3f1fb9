"""Streams against the batch operators, replays included."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobmart.catalog.fixtures import fixture, table
from jobmart.operators import timerange
from jobmart.plans import jobs_flow
from jobmart.schemas import JOB_BRONZE
from jobmart.session import work_dir
from jobmart.streaming import incremental

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark):
    return fixture(spark, SF_DIR, "jobs_raw")


def split(raw, *days):
    day = F.to_date("ExtractionDatetime")
    bounds = [None, *days, None]
    for low, high in zip(bounds, bounds[1:]):
        part = raw
        if low:
            part = part.filter(day >= F.lit(low).cast("date"))
        if high:
            part = part.filter(day < F.lit(high).cast("date"))
        yield part


def upsert_all(spark, landing, out, raw):
    stream = incremental.landing_stream(spark, landing, raw.schema, files_per_batch=1)
    incremental.start_job_upserts(stream, out, f"{out}-checkpoint").awaitTermination()


def test_upserts_over_several_runs_equal_one_batch(spark, raw):
    landing, out = work_dir(spark, "landing"), work_dir(spark, "jobs")
    parts = list(split(raw, "2024-01-10", "2024-01-20"))
    for part in (parts[2], parts[0], parts[1]):  # late data too
        part.coalesce(1).write.mode("append").parquet(landing)
        upsert_all(spark, landing, out, raw)
    wanted = rows(jobs_flow.one_per_job(raw))
    assert rows(incremental.current_jobs(spark, out)) == wanted


def test_retention_over_batches_and_compaction(spark):
    """One sighting per job and run: the stream's table equals the batch form at every point in time."""
    sightings = [
        (1, "a", "2024-01-02 10:00:00"), (2, "b", "2024-01-02 10:00:00"), (1, "c", "2024-01-10 10:00:00"),
        (3, "d", "2024-01-10 10:00:00"), (2, "e", "2024-01-20 10:00:00"),
    ]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in JOB_BRONZE)
    landing, out = work_dir(spark, "landing"), work_dir(spark, "jobs")
    for time in sorted({t for *_, t in sightings}):
        batch = [
            tuple({"JobId": str(i), "JobTitle": title, "ExtractionDatetime": datetime.fromisoformat(t)}
                  .get(f.name) for f in JOB_BRONZE)
            for i, title, t in sightings if t == time
        ]
        spark.createDataFrame(batch, columns).coalesce(1).write.mode("append").parquet(landing)
        stream = incremental.landing_stream(spark, landing, JOB_BRONZE)
        incremental.start_job_upserts(stream, out, f"{out}-checkpoint").awaitTermination()
    bronze = spark.read.schema(JOB_BRONZE).parquet(landing)
    compacted = work_dir(spark, "compact")
    incremental.compact_jobs(spark, out, compacted, datetime(2024, 2, 5))
    for as_of in (datetime(2024, 2, 1), datetime(2024, 2, 5), datetime(2024, 2, 12), datetime(2024, 3, 1)):
        held = timerange.retain(bronze, "ExtractionDatetime", as_of)
        wanted = rows(timerange.retain(jobs_flow.one_per_job(held), "ExtractionDatetime", as_of))
        assert rows(incremental.current_jobs(spark, out, as_of)) == wanted
        if as_of >= datetime(2024, 2, 5):
            assert rows(incremental.current_jobs(spark, compacted, as_of)) == wanted


def test_a_repeated_batch_replaces_its_own_folder(spark, raw):
    landing, out = work_dir(spark, "landing"), work_dir(spark, "jobs")
    raw.coalesce(1).write.parquet(landing)
    upsert_all(spark, landing, out, raw)
    once = rows(incremental.current_jobs(spark, out))
    # A lost checkpoint makes the run take the same files again, as batch 0.
    stream = incremental.landing_stream(spark, landing, raw.schema)
    incremental.start_job_upserts(stream, out, f"{out}-other-checkpoint").awaitTermination()
    assert rows(incremental.current_jobs(spark, out)) == once


def test_closed_hours_equal_the_batch_counts(spark):
    events = table(spark, SF_DIR, "events")
    stream = incremental.landing_stream(spark, SF_DIR, events.schema, files="events.parquet")
    timed = incremental.with_event_time(stream, "ts", "10 minutes")
    out = work_dir(spark, "hourly")
    got = incremental.run_append(
        incremental.hourly_counts(timed, "ts", "event_type"), out, f"{out}-checkpoint"
    )
    batch = incremental.hourly_counts(
        events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type"
    )
    last = got.agg(F.max("hour")).first()[0]
    assert rows(got) == rows(batch.filter(F.col("hour") <= F.lit(last)))
    assert got.count() > 0


def test_a_second_run_takes_only_what_is_new(spark, raw):
    landing, out = work_dir(spark, "landing"), work_dir(spark, "ids")

    def run():
        stream = incremental.landing_stream(spark, landing, raw.schema)
        timed = incremental.with_event_time(
            stream.select("JobId", "ExtractionDatetime"), "ExtractionDatetime", "31 days"
        )
        ids = incremental.first_sightings(timed, ["JobId"]).select("JobId")
        return incremental.run_append(ids, out, f"{out}-checkpoint")

    for part in split(raw, "2024-01-15"):
        part.write.mode("append").parquet(landing)
        got = run()
    assert rows(got) == rows(raw.select("JobId").distinct())
    assert rows(run()) == rows(got)
