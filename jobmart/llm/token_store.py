"""Token ids in a binary file format with a shared dictionary.

A store is a folder with two Parquet tables. ``dictionary`` holds the zstandard dictionary trained on
serialised id arrays, its SHA-256 and the width of an id. In ``blocks`` a row is a run of documents in
ascending id order: each document's ids are one zstandard frame made with that dictionary, the frames
stand one after another in ``payload``, and ``offsets`` says where, so that one short document is read
by decompressing its own frame only. Spark writes and commits the files, so a lost executor leaves no
half-written block.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import prepare
from jobmart.llm.tokens import Encoding, encoder

#: The dictionary is fitted on this many documents at most, and on this much of each.
SAMPLE_DOCUMENTS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 65_536

#: A block is closed when its frames reach this size.
BLOCK_BYTES = 1 << 17

LEVEL = 3

FRAMES = "doc_id long, shard int, n_tokens long, frame binary"
BLOCKS = (
    "shard int, first_id long, last_id long, start long, n_tokens long, doc_ids array<long>, "
    "counts array<long>, offsets array<long>, payload binary, dictionary_sha256 string"
)


def serialise(ids: bytes, width: int) -> bytes:
    """Little-endian 32-bit ids in ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def restore(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of DICTIONARY_BYTES at most; few samples serve as its content as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content))


def _decompressor(content: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(content))


def write_store(docs: DataFrame, path: str, encoding: Encoding, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text and write the store; a NULL text is empty.

    Rows with one id stay side by side, ordered by length and content; rows without an id come
    first. No rows give a store without blocks.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = rows.select("doc_id").count()

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(encoding)
        for batch in batches:
            ids = encode(batch.column(0).to_pylist())
            yield pa.record_batch([pa.array([i[:2 * SAMPLE_BYTES] for i in ids], pa.binary())], ["ids"])

    share = min(1.0, 1.5 * SAMPLE_DOCUMENTS / max(1, total))
    picked = rows.select("text").sample(fraction=share, seed=11).limit(SAMPLE_DOCUMENTS)
    drawn = [r[0] for r in picked.mapInArrow(sample, "ids binary").collect()]
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(encoding.path).get_vocab_size(), encoding.end_id + 1) <= 1 << 16 else 4
    content = train_dictionary([serialise(bytes(i), width)[:SAMPLE_BYTES] for i in drawn])
    sha = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(bytearray(content), sha, width)], "content binary, sha256 string, width int") \
        .write.parquet(f"{path}/dictionary")

    n_shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n_shards for i in range(1, n_shards)], 100_000)).first()[0]
    bounds = np.array(sorted(set(cuts or [])), np.int64)
    shared = spark.sparkContext.broadcast(content)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, compress = encoder(encoding), _compressor(shared.value).compress
        for batch in batches:
            ids = encode(batch.column(1).to_pylist())
            keys = batch.column(0)
            shards = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False))
            yield pa.record_batch([
                keys, pa.array(shards, pa.int32()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([compress(serialise(i, width)) for i in ids], pa.binary()),
            ], ["doc_id", "shard", "n_tokens", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start, held, size = None, 0, [], 0

        def block() -> pa.RecordBatch:
            ids, counts, data = zip(*held)
            named = [i for i in ids if i is not None]
            row = {
                "shard": shard, "first_id": min(named, default=None), "last_id": max(named, default=None),
                "start": start, "n_tokens": sum(counts), "doc_ids": list(ids), "counts": list(counts),
                "offsets": np.cumsum([0, *map(len, data)]).tolist(), "payload": b"".join(data),
                "dictionary_sha256": sha,
            }
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for batch in batches:
            for key, at, count, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (at != shard or size >= BLOCK_BYTES):
                    yield block()
                    start += sum(c for _, c, _ in held)
                    held, size = [], 0
                if at != shard:
                    shard, start = at, 0
                held.append((key, count, frame))
                size += len(frame)
        if held:
            yield block()

    ordered = (
        rows.mapInArrow(frames, FRAMES).repartition(n_shards // 4, "shard")
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "n_tokens", "frame")
    )
    # Frames are compressed already.
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


BLOCK_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("start", pa.int64()),
    ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int64())), ("payload", pa.binary()), ("dictionary_sha256", pa.string()),
])


def read_store(
    spark: SparkSession, path: str, only: list[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """Per document, read from the files: doc_id, start, n_tokens, ids (little-endian 32-bit), ids_crc32.

    Without ``with_ids`` the ids are checked and counted but not returned. ``start`` counts the ids of all documents before it. ``only`` (a short list of ids) skips blocks by
    their id range and decompresses the frames of those documents alone.
    """
    prepare(spark)
    content, sha, width = spark.read.parquet(f"{path}/dictionary").first()
    content = bytes(content)
    if hashlib.sha256(content).hexdigest() != sha:
        raise ValueError(f"the dictionary of {path} is damaged")
    blocks = spark.read.parquet(f"{path}/blocks")
    base, before = {}, 0
    for shard, count in sorted(blocks.groupBy("shard").agg(F.sum("n_tokens")).collect()):  # bounded by the shards
        base[shard], before = before, before + count
    shared = spark.sparkContext.broadcast((content, base))
    wanted = None if only is None else frozenset(only)
    if wanted is not None:
        near = F.lit(False)
        for i in wanted:
            near = near | ((F.col("first_id") <= i) & (F.col("last_id") >= i))
        blocks = blocks.where(near)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, starts = shared.value
        decompress = _decompressor(known).decompress
        for batch in batches:
            for k in range(batch.num_rows):  # one block in memory at a time
                row = batch.slice(k, 1).to_pylist()[0]
                if row["dictionary_sha256"] != sha:
                    raise ValueError("a block was written with another dictionary")
                at, out = starts[row["shard"]] + row["start"], []
                view = memoryview(row["payload"])
                places = zip(row["offsets"], row["offsets"][1:])
                for key, count, (begin, end) in zip(row["doc_ids"], row["counts"], places):
                    if wanted is None or key in wanted:
                        ids = restore(decompress(view[begin:end]), width)
                        out.append((key, at, len(ids) // 4, ids if with_ids else None, zlib.crc32(ids)))
                    at += count
                if out:
                    columns = list(zip(*out))
                    yield pa.record_batch(
                        [pa.array(c, t) for c, t in zip(columns, DOCUMENT_SCHEMA.types)], schema=DOCUMENT_SCHEMA
                    )

    return blocks.select("shard", "start", "doc_ids", "counts", "offsets", "payload", "dictionary_sha256") \
        .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


DOCUMENT_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
    ("ids_crc32", pa.int64()),
])
