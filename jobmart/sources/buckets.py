"""Tables bucketed by key, whose upserts shuffle the batch alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.operators.merge import align


def _save(df: DataFrame, name: str, path: str, key: list[str], buckets: int) -> DataFrame:
    df.write.bucketBy(buckets, *key).mode("errorifexists").option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, key: list[str], buckets: int) -> DataFrame:
    """A table of ``buckets`` buckets by ``key``, one file each; the rows are shuffled once, here."""
    return _save(df.repartition(buckets, *key), name, path, key, buckets)


def upserted(target: DataFrame, source: DataFrame, key: list[str], buckets: int) -> DataFrame:
    """Matched rows replaced, the others added, as ``operators.merge.upsert`` does, for a bucketed target.

    Both sides meet in a full join by bucket: the batch is shuffled into the target's buckets, the target is
    read where it lies, and the result is still cut by bucket. A source key that occurs twice and matches fails
    the job; NULL keys match nothing.
    """
    columns = target.columns
    rows = align(source, columns).repartition(buckets, *key)
    rows = rows.withColumn("_hits", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    rows = rows.select(*(F.col(f"`{c}`").alias(f"_new_{c}") for c in columns), "_hits")
    old = target.withColumn("_old", F.lit(True))
    on = [F.col(f"`{k}`") == F.col(f"`_new_{k}`") for k in key]
    twice = F.raise_error(F.lit(f"several source rows match one target row on {key}"))
    met = old.join(rows, on, "full").filter(F.when(F.col("_old") & (F.col("_hits") > 1), twice).otherwise(F.lit(True)))
    new = F.col("_hits").isNotNull()
    return met.select(*(F.when(new, F.col(f"`_new_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in columns))


def upsert_bucketed(name: str, source: DataFrame, new_name: str, path: str, key: list[str], buckets: int) -> DataFrame:
    """The next version of the bucketed table ``name`` as ``new_name``, written by bucket without another shuffle."""
    target = source.sparkSession.table(name)
    return _save(upserted(target, source, key, buckets), new_name, path, key, buckets)
