"""What the operators share: row keys, written intermediates, batches, joins under heavy keys."""

from __future__ import annotations

import os

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.session import work_dir
from jobmart.sources.tables import delete_folder

#: Rows of whole texts that travel to Python in one batch: bounds a worker's memory.
BATCH_ROWS = 500

#: A key with a thousandth of all rows counts as heavy, so at most a thousand keys are heavy.
HEAVY_SHARE = 1000

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Small batches for texts, and the package on the workers' path for a local master.

    A cluster gets the package by ``--py-files`` or an installation; a path it lacks does no harm.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        joined = os.pathsep.join(p for p in [*paths, PACKAGE_ROOT] if p)
        spark.sparkContext.environment["PYTHONPATH"] = joined


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: evaluated once, and safe from lost executors."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` returned and nothing reads any more."""
    for table in tables:
        delete_folder(table.sparkSession, table._folder, table._folder.rsplit("/", 1)[0])


def row_hash(doc_id: str, text: str) -> Column:
    """Tells rows apart that share an id; equal rows get equal hashes."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def same(left: Column, right: Column) -> Column:
    """Equality for which a missing value equals a missing value."""
    return left.eqNullSafe(right)


#: Bits of a bitmap for each row in it, and most bits of it (32 MB).
BITS_A_ROW, MOST_BITS = 16, 1 << 28


def row_bitmap(rows: DataFrame, key: str) -> Broadcast:
    """The slots of the keys (longs) of ``rows`` (a written table) as packed bits: a bit in sixteen is set, or fewer.

    It lets a scan of texts skip most rows that are not wanted; what it lets through is joined exactly.
    Its size follows the number of rows up to MOST_BITS; with more rows it lets more through and saves less.
    """
    size = 1 << min(MOST_BITS.bit_length() - 1, max(15, (BITS_A_ROW * rows.count()).bit_length()))
    slot = F.pmod(F.col(key), F.lit(size)) + 1  # Spark numbers the bits of buckets from 1
    parts = rows.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bitmap = np.zeros(size // 8, np.uint8)
    for bucket, bits in parts.toLocalIterator():  # at most size / 32768 rows of 4 KB
        bitmap[(bucket - 1) * len(bits):bucket * len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bitmap)


def marked_rows(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their slot set."""
    slot = keys % (8 * len(bitmap))
    return (bitmap[slot >> 3] >> (slot & 7) & 1).astype(bool)


def without_rows(docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not among ``dropped`` (doc_id, row), with their columns as they are."""
    gone = dropped.select(F.col("doc_id").alias("_gone_id"), F.col("row").alias("_gone_row")).distinct()
    on = same(docs[doc_id].cast("long"), gone["_gone_id"]) & (row_hash(doc_id, text) == gone["_gone_row"])
    return docs.join(gone, on, "left_anti")


def split_heavy(groups: DataFrame, size: str, total: int) -> tuple[DataFrame, DataFrame]:
    """Groups with at least a thousandth of ``total`` rows, and the others.

    The sizes add up to ``total`` at most, so the first part has at most ``HEAVY_SHARE`` rows: that
    is the bound under which it may be broadcast.
    """
    heavy = F.col(size) * HEAVY_SHARE >= F.lit(total)
    return groups.where(heavy), groups.where(~heavy)


def attach(left: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``groups`` (one row per key, with its size) on ``key``.

    Rows of heavy keys meet their group by broadcast and are never shuffled; no other key has more
    than a thousandth of the rows. Both inputs should be written tables, as each is read twice.
    """
    heavy, light = split_heavy(groups, size, total)
    heavy = F.broadcast(heavy)
    rest = left.join(heavy, key, "left_anti").join(light, key)
    return left.join(heavy, key).unionByName(rest)
