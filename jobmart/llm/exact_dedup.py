"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal if they are identical without the characters ``[\\x20\\x09-\\x0D]``. A first pass over
the texts gives lengths and prefix hashes, which are counted (map side first): a text alone with its
length, or with its length and prefix, is settled. The survivors go into a bitmap of fixed size, and
only texts it names are hashed in full by the second pass. A collision in the bitmap costs one more
hash and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import attach, marked_rows, prepare, row_bitmap, row_hash, same, without_rows, written

#: Deleted before texts are compared.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Bytes of the normalised text that the prefix hash covers.
PREFIX_BYTES = 64


def _bytes(column: pa.Array) -> list[bytes]:
    return [(v or b"").translate(None, WHITE) for v in column.cast(pa.binary()).to_pylist()]


def _shape(content: bytes) -> tuple[int, int]:
    return len(content), xxhash.xxh64_intdigest(content[:PREFIX_BYTES]) >> 1


def _slot(length: int, prefix: int) -> int:
    return prefix ^ (length * 0x9E3779B1)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(n, p, _slot(n, p)) for n, p in map(_shape, _bytes(batch.column(0)))]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["length", "prefix", "slot"])


def survivors(docs: DataFrame, text: str = "text") -> Broadcast:
    """Bitmap of the (length, prefix hash) pairs that several rows share."""
    shapes = docs.select(text).mapInArrow(_shapes, "length long, prefix long, slot long")
    sizes = shapes.groupBy("length", "prefix", "slot").count()
    by_length = sizes.groupBy("length").agg(F.sum("count").alias("rows"))
    left = sizes.where("count > 1").join(by_length.where("rows > 1"), "length", "left_semi")
    return row_bitmap(written(left.select("slot"), "exact-survivors"), "slot")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, row, n_chars, shared, text_sha256.

    ``text_sha256`` is NULL for texts settled by length and prefix, unless ``hash_all``.
    """
    prepare(docs.sparkSession)
    bitmap = survivors(docs, text)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = _bytes(batch.column(3))
            shared = marked_rows(bitmap.value, np.array([_slot(*_shape(c)) for c in contents], np.int64))
            sha = [hashlib.sha256(c).hexdigest() if s or hash_all else None for c, s in zip(contents, shared)]
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(shared, pa.bool_()), pa.array(sha, pa.string())],
                ["doc_id", "row", "n_chars", "shared", "text_sha256"],
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"),
        F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"), F.col(text).alias("text"),
    )
    schema = "doc_id long, row long, n_chars long, shared boolean, text_sha256 string"
    return rows.mapInArrow(full, schema)


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_all: bool = False
) -> DataFrame:
    """Per row: doc_id, row, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with most code points, then the smallest id, is kept. A NULL text counts
    as empty, and all empty texts are equal. Rows without an id take part and come after any id.
    Rows repeated in full are all marked as kept. No rows give no rows; other columns are ignored.
    """
    found = written(digests(docs, doc_id, text, hash_all), "exact-digests")
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = written(
        found.where("shared").groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
        .where("group_size > 1")
        .select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")),
        "exact-groups",
    )
    names = ["doc_id", "row", "keep_id", "group_size", "kept", "text_sha256"]
    shared = found.where("shared")
    in_groups = attach(shared, groups, "text_sha256", "group_size", found.count()).withColumn(
        "kept", same(F.col("doc_id"), F.col("keep_id")) & (F.col("row") == F.col("keep_row"))
    )
    heavy_or_not = groups.select("text_sha256")
    alone = found.where("not shared").unionByName(shared.join(heavy_or_not, "text_sha256", "left_anti"))
    alone = alone.withColumns(
        {"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    return in_groups.select(names).unionByName(alone.select(names))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, one for each group, with their columns as they are."""
    groups = exact_groups(docs, doc_id, text)
    kept = without_rows(docs, groups.where("not kept"), doc_id, text)
    repeated = groups.where("kept").groupBy("doc_id", "row").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([doc_id, text])  # rows repeated in full
