"""Incremental runs: each ``availableNow`` run takes what landed since the last one and stops.

Checkpoints and outputs live in folders the caller names, which must be shared by all executors.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from jobmart.operators import dedup, timerange
from jobmart.plans import jobs_flow
from jobmart.schemas import JOB_SILVER


def landing_stream(
    spark: SparkSession, folder: str, schema: StructType, files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they land in ``folder``, those matching ``files`` if given."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def with_event_time(stream: DataFrame, ts: str, late: str) -> DataFrame:
    """A watermark on ``ts``, which must be a TIMESTAMP: zone-less times are cast first."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def hourly_counts(events: DataFrame, ts: str, *by: str) -> DataFrame:
    """Rows per clock hour and group; the same expression for a batch and a stream."""
    return events.groupBy(F.window(ts, "1 hour").alias("_w"), *by).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("_w.start").alias("hour"), *by, "n")


def with_open_hours(closed: DataFrame, events: DataFrame, ts: str, *by: str) -> DataFrame:
    """Closed hours of a stream and, counted in one batch, the hours that are still open.

    A stream lets an hour go once later events push the watermark past it. On request the rest is
    counted from the landed events after the last closed hour; that hour is all the driver gets.
    """
    last = closed.agg(F.max("hour")).first()[0]
    if last is not None:
        events = events.filter(F.col(ts) >= F.lit(last + timedelta(hours=1)).cast(events.schema[ts].dataType))
    return closed.unionByName(hourly_counts(events, ts, *by))


def first_sightings(stream: DataFrame, key: list[str]) -> DataFrame:
    """One row per key within the watermark; the state drops keys once they are out of it."""
    return stream.dropDuplicatesWithinWatermark(key)


def run_append(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Take all that landed, append what is final to Parquet under ``out``, return the table."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def start_job_upserts(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Upsert bronze micro-batches by job id into the table under ``out``.

    A batch writes its own first sightings to ``batch_id=<n>`` and nothing else, so the cost of a run
    follows the batch and not the table, and a batch that is repeated after a failure replaces its own
    folder. ``current_jobs`` settles jobs that occur in several batches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = dedup.keep_one(jobs_flow.edge_sightings(batch), jobs_flow.KEY, jobs_flow.SEEN)
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _batches(spark: SparkSession, out: str) -> DataFrame:
    schema = StructType([*JOB_SILVER, StructField(jobs_flow.SEEN, TimestampNTZType())])
    return spark.read.schema(schema).parquet(out).drop("batch_id")


def current_jobs(spark: SparkSession, out: str, as_of: datetime | None = None) -> DataFrame:
    """Silver jobs from the batches under ``out``: the first sighting of every job, whichever batch.

    With ``as_of``, the first among the sightings that retention still holds, and of these the jobs
    whose own time it holds.
    """
    rows = _batches(spark, out)
    if as_of:
        rows = timerange.retain(rows, jobs_flow.SEEN, as_of)
    jobs = dedup.keep_one(rows, jobs_flow.KEY, jobs_flow.SEEN).drop(jobs_flow.SEEN)
    return timerange.retain(jobs, jobs_flow.TIME, as_of) if as_of else jobs


def compact_jobs(spark: SparkSession, out: str, new_out: str, as_of: datetime) -> None:
    """Merge the small files of all batches under ``new_out`` and leave out expired sightings.

    Later sightings stay: one of them becomes the first when those before it expire. Later runs add
    their batches to ``new_out``.
    """
    rows = timerange.retain(_batches(spark, out), jobs_flow.SEEN, as_of)
    rows.hint("rebalance").write.mode("errorifexists").parquet(f"{new_out}/batch_id=-1")
