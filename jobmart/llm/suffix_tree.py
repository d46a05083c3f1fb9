"""A probabilistic suffix tree over the characters of normalised texts.

A text is its lower-cased words joined by one blank and closed by an end symbol, as UTF-8 bytes, so a
sequence of words and its bytes have the same probability and no word is unknown. Every context of up
to ``DEPTH`` bytes that was seen more than once and whose next-symbol distribution diverges from its
parent's by more than it costs to keep becomes a state. Its distribution is smoothed by its parent's, down
to the root's add-one distribution. A text is scored by the longest state that is a suffix of what was read.

The tree is never in one place. What a symbol scores follows from its window, the DEPTH bytes before it and
itself. Blocks of texts ask for their windows; contexts with the same last LOW + 1 bytes meet in one bucket,
which holds all that their states need but the lowest levels, and those are bounded by the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import prepare, written
from jobmart.llm.words import hashes, words

#: Longest context in bytes; a context and its next symbol fit a 64-bit code.
DEPTH = 6

#: A context that was seen once says nothing about what else may follow; any other is put to the divergence test.
LEAST = 2

#: Contexts of up to this many bytes go to all tasks: at most SYMBOLS ** (LOW + 1) counts, whatever the input.
LOW = 2

#: Buckets of windows, for each BUCKET_BLOCKS blocks: bounds what a task of them holds.
BUCKETS, BUCKET_BLOCKS = 256, 2048

#: Pads the start and ends a text; being white space, it is never part of a word.
END = 10

SYMBOLS = 256

#: Texts are scored in blocks of about this many bytes, which bounds a task's memory.
BLOCK_BYTES = 16 << 20


def symbols(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, each after DEPTH pads; and where each begins, pads included."""
    parts = [bytes([END]) * DEPTH + b" ".join((t or b"").lower().split()) + bytes([END]) for t in texts]
    starts = np.cumsum([0, *map(len, parts)])
    return np.frombuffer(b"".join(parts), np.uint8), starts


def _scored(starts: np.ndarray) -> np.ndarray:
    """Which places are symbols and not pads."""
    mask = np.ones(starts[-1], bool)
    for k in range(DEPTH):
        mask[starts[:-1] + k] = False
    return mask


@dataclass
class Level:
    """Contexts of one length, each with its next symbols, ``ctx << 8 | symbol``, in order."""

    keys: np.ndarray
    c: np.ndarray  # how often the symbol follows
    n: np.ndarray  # how often the context stands
    p: np.ndarray  # probability of the symbol


def levels(codes: np.ndarray, c: np.ndarray, first: int, last: int, above: Level | None = None) -> Level:
    """The level ``last`` of distinct windows with their counts, by way of ``first``; ``above`` is the one before.

    The windows must hold all that share a context of ``first`` bytes with one of them.
    """
    for k in range(first, last + 1):
        keys, at = np.unique(codes & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        own = np.bincount(at, weights=c, minlength=len(keys))
        ctx = keys >> 8
        new = np.r_[True, ctx[1:] != ctx[:-1]][:len(keys)]
        starts, of = np.flatnonzero(new), np.cumsum(new) - 1
        n = np.add.reduceat(own, starts) if len(keys) else own
        kinds = np.add.reduceat((own > 0).astype(float), starts) if len(keys) else own
        if above is None:
            p = (own + 1) / (n[of] + SYMBOLS)
        else:
            up = np.searchsorted(above.keys, keys & ((1 << 8 * k) - 1))
            seen = own > 0
            gain = np.zeros(len(keys))
            gain[seen] = own[seen] * np.log(own[seen] / n[of][seen] * (above.n[up][seen] / above.c[up][seen]))
            gain = np.add.reduceat(gain, starts) if len(keys) else gain
            kept = (n >= LEAST) & (gain > 0.5 * kinds * np.log(np.maximum(n, 1)))
            p = np.where(kept[of], (own + kinds[of] * above.p[up]) / np.maximum(n + kinds, 1)[of], above.p[up])
        above = Level(keys, own, n[of], p)
    return above


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of all parts, in order, and the sums of their counts."""
    codes, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    starts = _firsts(codes)
    return codes[starts], np.add.reduceat(counts, starts) if len(codes) else counts


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of an ordered array begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and how often each stands there. Plain sorting is several times as fast as hashing."""
    ordered = np.sort(codes)
    starts = _firsts(ordered)
    return ordered[starts], np.diff(starts, append=len(ordered))


def looked_up(codes: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each code; ``known`` holds them all, in order."""
    order = np.argsort(codes)
    ordered = codes[order]
    starts = _firsts(ordered)
    each = np.empty(len(codes))
    each[order] = np.repeat(values[np.searchsorted(known, ordered[starts])], np.diff(starts, append=len(codes)))
    return each


def places(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The window of each symbol of the texts, and how many each text has."""
    read, starts = symbols(texts)
    codes = np.zeros(max(0, len(read) - DEPTH), np.int64)
    for k in range(DEPTH + 1):
        codes <<= 8
        codes |= read[k:len(read) - DEPTH + k]
    return codes[_scored(starts)[DEPTH:]], np.diff(starts) - DEPTH


def bucket_of(codes: np.ndarray, n_buckets: int) -> np.ndarray:
    """By the last LOW + 1 bytes of the context."""
    ctx = (codes >> 8) & ((1 << 8 * (LOW + 1)) - 1)
    return ((ctx * 0x9E3779B1 & 0xFFFFFFFF) >> 8) % n_buckets


def packed(codes: np.ndarray, n: np.ndarray) -> bytes:
    """Rising codes, as steps, and their counts; equal bytes come together."""
    both = np.concatenate([np.diff(codes, prepend=0), n.astype(np.int64)])
    return pa.compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpacked(blob: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, 16 * length, "zstd", asbytes=True), np.uint8)
    both = np.ascontiguousarray(raw.reshape(8, -1).T).reshape(-1).view(np.int64)
    return np.cumsum(both[:length]), both[length:]


def _slices(texts: pa.ChunkedArray) -> Iterator[tuple[int, list[bytes | None]]]:
    for at in range(0, len(texts), 256):
        yield at, texts.slice(at, 256).cast(pa.binary()).to_pylist()


def score_texts(docs: DataFrame, doc_id: str, text: str, training: str) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score. A NULL text is empty.

    ``training`` names a boolean column: from these rows the tree and the word counts are learned.
    The base score is that of single words with add-one smoothing. Neither word counts nor states, which
    grow with the corpus, are ever gathered: a block of documents asks for the counts of its own words and
    for what its own windows score, and is sent those. Without training rows the tree is the uniform root.
    Rows without an id are scored too.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.col(training), F.lit(False)).alias("training"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = size // BLOCK_BYTES + 1
    n_buckets = BUCKETS * (1 + n_blocks // BUCKET_BLOCKS)
    placed = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))

    def ask(table: pa.Table) -> pa.Table:
        flat, at = words(table["text"].combine_chunks())
        coded = flat.dictionary_encode()
        used = table["training"].to_numpy()
        n = np.bincount(coded.indices.to_numpy()[used[at]], minlength=len(coded.dictionary))
        word = hashes(coded.dictionary)
        del flat, at, coded
        pa.default_memory_pool().release_unused()
        codes, times, parts = np.empty(0, np.int64), np.empty(0, np.int64), []
        for begin, texts in _slices(table["text"]):
            own, lengths = places(texts)
            marked, seen = counted(own << 1 | np.repeat(used[begin:begin + len(texts)], lengths))
            parts.append((marked >> 1, seen * (marked & 1)))
            if len(parts) == 8:
                codes, times = summed([(codes, times), *parts])
                parts = []
        codes, times = summed([(codes, times), *parts])
        low, to = np.unique(codes & ((1 << 8 * (LOW + 1)) - 1), return_inverse=True)
        low_n = np.bincount(to, weights=times, minlength=len(low)).astype(np.int64)
        bucket = bucket_of(codes, n_buckets)
        order = np.argsort(bucket, kind="stable")
        codes, times, bucket = codes[order], times[order], bucket[order]
        names, starts = np.unique(bucket, return_index=True)
        ends = [*starts[1:].tolist(), len(codes)]
        blobs = [packed(codes[i:j], times[i:j]) for i, j in zip(starts.tolist(), ends)]
        sizes = [len(word), len(low), len(names)]
        pa.default_memory_pool().release_unused()
        return pa.table({
            "kind": np.repeat(np.array([WORD, LOWEST, WINDOWS], np.int32), sizes),
            "block": np.full(sum(sizes), table["block"][0].as_py(), np.int32),
            "key": np.concatenate([word, low, names]), "n": np.concatenate([n, low_n, np.array(ends) - starts]).astype(np.int64),
            "windows": pa.array([*[None] * (len(word) + len(low)), *blobs], pa.binary()),
        })

    asked = written(
        placed.groupBy("block").applyInArrow(ask, "kind int, block int, key long, n long, windows binary"), "suffix-asked"
    )
    lowest = asked.where(F.col("kind") == LOWEST).groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    shared = spark.sparkContext.broadcast(levels(lowest["key"].to_numpy(), lowest["n"].to_numpy(), 0, LOW))

    def answer(table: pa.Table) -> pa.Table:
        lengths = table["n"].to_pylist()
        parts = [unpacked(b, m) for b, m in zip(table["windows"].to_pylist(), lengths)]
        codes, times = (np.concatenate(x) for x in zip(*parts))
        del parts
        codes, to = np.unique(codes, return_inverse=True)
        times = np.bincount(to, weights=times, minlength=len(codes))
        logs = np.log10(levels(codes, times, LOW + 1, DEPTH, shared.value).p).astype(np.float32)[to]
        ends = np.cumsum(lengths).tolist()
        logs = [logs[j - m:j].tobytes() for j, m in zip(ends, lengths)]
        return pa.table({"block": table["block"], "key": table["key"], "logs": pa.array(logs, pa.binary())})

    scores = asked.where(F.col("kind") == WINDOWS).select("block", "key", "n", "windows").groupBy("key") \
        .applyInArrow(answer, "block int, key long, logs binary")
    one_word = Window.partitionBy("key")  # a word has one row per block at most
    known_words = asked.where(F.col("kind") == WORD).select(
        "block", "key", F.sum("n").over(one_word).alias("n"),
        F.when(F.min("block").over(one_word) == F.col("block"), 1).otherwise(0).alias("first"),
    )
    answers = known_words.unionByName(scores, allowMissingColumns=True)

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        n_rows = texts.num_rows
        is_word = known["logs"].is_null()
        by_bucket = known.filter(known["logs"].is_valid()).sort_by("key")["logs"].to_pylist()
        known = known.filter(is_word).select(["key", "n", "first"])
        order = np.argsort(known["key"].to_numpy())
        word, count = known["key"].to_numpy()[order], known["n"].to_numpy()[order]
        flat, at = words(texts["text"].combine_chunks())
        coded = flat.dictionary_encode()
        c = count[np.searchsorted(word, hashes(coded.dictionary))] if len(flat) else np.empty(0, np.int64)
        c = c[coded.indices.to_numpy()] if len(flat) else c
        logs = np.bincount(at, weights=np.log10(c + 1.0), minlength=n_rows)
        tokens = (np.bincount(at, minlength=n_rows) + 1).tolist()
        found = np.bincount(at, weights=c > 0, minlength=n_rows).astype(np.int64).tolist()
        del flat, at, coded, c
        pa.default_memory_pool().release_unused()
        codes, new = np.empty(0, np.int64), []
        for _, some in _slices(texts["text"]):
            new.append(counted(places(some)[0])[0])
            if len(new) == 8:
                codes, new = counted(np.concatenate([codes, *new]))[0], []
        codes = counted(np.concatenate([codes, *new]))[0]
        log = np.empty(len(codes), np.float32)  # answers come by bucket, in the order of the codes there
        log[np.argsort(bucket_of(codes, n_buckets), kind="stable")] = np.frombuffer(b"".join(by_bucket), np.float32)
        chunks = []
        for _, some in _slices(texts["text"]):  # cut up again: to keep the places of a block takes its memory eight times
            own, lengths = places(some)
            chunks.append(np.add.reduceat(looked_up(own, codes, log), np.cumsum(lengths) - lengths))
        first = (known["first"].to_numpy() == 1) & (known["n"].to_numpy() > 0)
        out = {
            "doc_id": [*texts["doc_id"].to_pylist(), None], "of_corpus": [*[False] * n_rows, True],
            "tokens": [*tokens, int(known["n"].to_numpy()[first].sum())],
            "known": [*found, int(first.sum())],
            "logs": [*logs.tolist(), 0.0],
            "score": [*(np.concatenate(chunks).tolist() if chunks else []), 0.0],
        }
        pa.default_memory_pool().release_unused()
        return pa.table(out, schema=SCORED_SCHEMA)

    scored = written(
        placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORED), "suffix-scores"
    )
    corpus = scored.where("of_corpus").agg(F.sum("tokens"), F.sum("known")).first()
    ends = rows.where("training").count()
    n, v = (corpus[0] or 0) + ends, (corpus[1] or 0) + (1 if ends else 0)
    base = F.col("logs") + F.lit(float(np.log10(ends + 1))) - F.col("tokens") * F.lit(float(np.log10(n + v + 1)))
    return scored.where("not of_corpus").select(
        "doc_id", F.col("tokens").alias("n_tokens"), (F.col("known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )


#: Kinds of rows by which blocks ask.
WORD, LOWEST, WINDOWS = range(3)

SCORED = "doc_id long, of_corpus boolean, tokens long, known long, logs double, score double"
SCORED_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("of_corpus", pa.bool_()), ("tokens", pa.int64()), ("known", pa.int64()),
    ("logs", pa.float64()), ("score", pa.float64()),
])
