"""Phrases that occur often and hold together, by sorting suffix pointers.

Words are counted first, for each language apart. A place of the corpus at which a frequent word is followed
by another in the same piece is a suffix, cut off at MAX_WORDS words or before a word that is not frequent: no
frequent phrase goes beyond. Suffixes are routed by their leading words: by the first, and where that is a
heavy word by those up to the first that is not, so that no route grows with one word. What shares a route is
sorted in one bucket by multikey three-way quicksort of pointers: a partition that equals its pivot holds the
suffixes with one more word in common, so its size is that phrase's count; it goes on to the next word, and one
that is too small is abandoned. A phrase of heavy words only has parts in several buckets, which are added up.

Words travel as numbers: the most frequent ones by rank, whose number a share of the corpus bounds, the others as
64-bit hashes of language and word. Two words of one hash would count as one; with 100 million
different words that happens anywhere with a probability of 0.0003.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import prepare, written
from jobmart.llm.words import byte_set, cut

#: Phrases have two words at least, and MAX_WORDS at most.
MAX_WORDS = 4

#: A phrase must occur so often; SCALE times its share is its score; so many are reported for each language.
LEAST, SCALE, FIRST = 30, 2_000_000, 2000

#: A phrase goes if a longer one around it has this percentage of its occurrences.
COVERED = 80

#: A word that is one in HEAD of all travels by its rank: HEAD words at most, in every task.
HEAD = 1 << 16

#: A word that is one in HEAVY of all is heavy: HEAVY words at most. Routes have a smaller share than that.
HEAVY = 1000

#: Suffixes that a task sorts and adds up before it hands them on, and suffixes in a bucket, about.
CHUNK, BUCKET = 1_000_000, 500_000

#: Bits for each frequent word in the filter that rare words are held against, and most bits of it (32 MB).
FILTER_BITS, MOST_BITS = 16, 1 << 28

UNKNOWN_LANGUAGE = "und"

_ENDS = byte_set(*map(ord, ".,;:!?"), range(0x0A, 0x0E))
_SEPARATORS = _ENDS | byte_set(0x20, 0x09)

_CODES = [f"c{k}" for k in range(MAX_WORDS)]


def _hash(lang: str, word: str) -> int:
    """The hash that Spark's ``xxhash64(lang, word)`` gives, without a sign and above all ranks."""
    value = xxhash.xxh64_intdigest(word.encode(), xxhash.xxh64_intdigest(lang.encode(), 42))
    return value if value > HEAD else value + HEAD + 1


def _hash_column() -> Column:
    value = F.xxhash64("lang", "word")
    return F.when(value.between(0, HEAD), value + HEAD + 1).otherwise(value)


@dataclass
class Frequent:
    """What tasks know of the frequent words: ranks of the most frequent, which are heavy, a filter for the others."""

    head: pa.Array  # "lang \0 word", rank by place
    heavy: int  # the first so many are heavy
    bits: np.ndarray

    def codes(self, keys: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words: 1 and up for ranks, the hash for others, 0 for words that are not frequent."""
        rank = pc.fill_null(pc.index_in(keys, value_set=self.head), -1).to_numpy().astype(np.int64)
        slot = hashes & np.uint64(8 * len(self.bits) - 1)
        maybe = (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return np.where(rank >= 0, (rank + 1).astype(np.uint64), np.where(maybe, hashes, np.uint64(0)))


@dataclass
class Coded:
    """Words of a batch: distinct (language, word) keys, which one stands at each position, and its piece."""

    langs: list[str]
    words: list[str]
    index: np.ndarray
    pieces: np.ndarray

    @property
    def keys(self) -> pa.Array:
        return pa.array([f"{a}\x00{w}" for a, w in zip(self.langs, self.words)], pa.large_string())

    def hashes(self) -> np.ndarray:
        return np.array([_hash(a, w) for a, w in zip(self.langs, self.words)], np.uint64)


def coded(langs: pa.Array, texts: pa.Array) -> Coded:
    flat, rows, pieces = cut(texts, _SEPARATORS, _ENDS)
    lang, word = langs.fill_null(UNKNOWN_LANGUAGE).dictionary_encode(), flat.dictionary_encode()
    width = max(1, len(word.dictionary))
    both = lang.indices.to_numpy().astype(np.int64)[rows] * width + word.indices.to_numpy()
    distinct, index = np.unique(both, return_inverse=True)
    names = lang.dictionary.to_pylist()
    return Coded([names[k] for k in (distinct // width).tolist()], word.dictionary.take(pa.array(distinct % width)).to_pylist(), index, pieces)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of ``docs`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = coded(batch.column(0), batch.column(1))
            n = np.bincount(own.index, minlength=len(own.words)).astype(np.int64)
            yield pa.record_batch([pa.array(own.langs, pa.string()), pa.array(own.words, pa.string()), pa.array(n)], ["lang", "word", "n"])

    return docs.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, total: int, least: int) -> tuple[Frequent, DataFrame]:
    """What tasks need of the words with ``least`` occurrences, and their table (lang, word, n, code).

    The filter is put together by Spark; its size follows the number of frequent words up to MOST_BITS.
    Beyond, it lets more rare words through, which are abandoned when sorted.
    """
    spark = counts.sparkSession
    often = counts.where(F.col("n") >= least)
    top = often.where(F.col("n") * HEAD >= total).collect()  # HEAD rows at most
    top.sort(key=lambda r: (-r.n, r.lang, r.word))
    ranks = spark.createDataFrame([(r.lang, r.word, k + 1) for k, r in enumerate(top)], "lang string, word string, rank long")
    coded_words = often.join(F.broadcast(ranks), ["lang", "word"], "left").select("lang", "word", "n", F.coalesce("rank", _hash_column()).alias("code"))
    table = written(coded_words, "collocation-frequent")
    size = 1 << min(MOST_BITS.bit_length() - 1, max(15, (FILTER_BITS * table.count()).bit_length()))
    slot = F.col("code").bitwiseAND(size - 1) + 1  # Spark numbers the bits of buckets from 1
    parts = table.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for bucket, part in parts.toLocalIterator():  # size / 32768 rows of 4 KB
        bits[(bucket - 1) * len(part):bucket * len(part)] = np.frombuffer(bytes(part), np.uint8)
    keys = pa.array([f"{r.lang}\x00{r.word}" for r in top], pa.large_string())
    return Frequent(keys, sum(r.n * HEAVY >= total for r in top), bits), table


def suffixes(code: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """The suffixes of two words or more, as columns of MAX_WORDS numbers, 0 after the end."""
    out = np.zeros((len(code), MAX_WORDS), np.uint64)
    going = code != 0
    for k in range(MAX_WORDS):
        n = len(code) - k
        if n <= 0:
            break
        going = going[:n] & (code[k:] != 0) & (pieces[k:] == pieces[:n])
        out[:n, k] = np.where(going, code[k:], 0)
    return out[(out[:, :2] != 0).all(axis=1)]


def _added_up(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, with their summed counts."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    return rows[new], np.add.reduceat(counts, np.flatnonzero(new))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def routes(rows: np.ndarray, heavy: int) -> np.ndarray:
    """A hash of the leading words up to the first that is not heavy."""
    state, going = np.zeros(len(rows), np.uint64), np.ones(len(rows), bool)
    for k in range(MAX_WORDS):
        state = np.where(going, _mixed(state * np.uint64(0x9E3779B97F4A7C15) + rows[:, k] + np.uint64(k + 1)), state)
        going &= (rows[:, k] > 0) & (rows[:, k] <= heavy)
    return state


def _packed(rows: np.ndarray, counts: np.ndarray) -> bytes:
    return zstandard.compress(np.concatenate([*rows.T, counts.astype(np.uint64)]).tobytes(), 1)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    columns = np.frombuffer(zstandard.decompress(blob), np.uint64).reshape(MAX_WORDS + 1, -1)
    return columns[:-1].T, columns[-1].astype(np.int64)


def routed(docs: DataFrame, frequent: Broadcast, buckets: int) -> DataFrame:
    """(bucket, suffixes): what a task found for a bucket, sorted, equal suffixes added up, packed into one value."""

    def hand_on(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate(rows)
        found, counts = _added_up(found, np.ones(len(found), np.int64))
        bucket = (routes(found, frequent.value.heavy) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        own, starts = np.unique(bucket[order], return_index=True)
        blobs = [_packed(found[at], counts[at]) for at in np.split(order, starts[1:])] if len(own) else []
        yield pa.record_batch([pa.array(own), pa.array(blobs, pa.binary())], ["bucket", "suffixes"])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [np.empty((0, MAX_WORDS), np.uint64)], 0
        for batch in batches:
            own = coded(batch.column(0), batch.column(1))
            if not len(own.words):
                continue
            code = frequent.value.codes(own.keys, own.hashes())[own.index]
            held.append(suffixes(code, own.pieces))
            n += len(held[-1])
            if n >= CHUNK:
                yield from hand_on(held)
                held, n = held[:1], 0
        yield from hand_on(held)

    return docs.mapInArrow(cut_up, "bucket long, suffixes binary")


def counted(rows: np.ndarray, counts: np.ndarray, least: int, heavy: int) -> Iterator[tuple[int, int, int]]:
    """(suffix, words, count) of the phrases of two words or more in a bucket.

    Multikey quicksort of pointers into ``rows``: a part is split by the pivot's word at its depth into what is
    smaller, equal and larger. A part with fewer than ``least`` occurrences is abandoned, unless it may be
    ``shared``: other buckets can hold more of what begins with heavy words only.
    """
    parts = [(np.arange(len(rows)), 0, True)]
    while parts:
        part, depth, shared = parts.pop()
        words = rows[part, depth]
        if shared:
            whole = words > heavy
            parts.append((part[whole], depth, False))
            part = part[~whole]
        while len(part) and (shared or counts[part].sum() >= least):
            words = rows[part, depth]
            pivot = words[len(words) // 2]
            equal = part[words == pivot]
            size = int(counts[equal].sum())
            last = depth + 1 == rows.shape[1]
            if pivot and (size >= least or shared and not last):
                if depth:
                    yield equal[0], depth + 1, size
                if not last:
                    parts.append((equal, depth + 1, shared))
            parts.append((part[words < pivot], depth, shared))
            part = part[words > pivot]


def phrase_counts(packed: DataFrame, frequent: Broadcast, least: int) -> DataFrame:
    """(c0 ... c3, n_words, a): every phrase of two words or more with ``least`` occurrences; 0 after its end."""

    def sort(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpacked(blob) for batch in groups for blob in batch.column("suffixes").to_pylist()]
        rows, counts = np.concatenate([r for r, _ in parts]), np.concatenate([c for _, c in parts])
        found = list(counted(rows, counts, least, frequent.value.heavy))
        at = np.array([f[0] for f in found], np.int64)
        length = np.array([f[1] for f in found], np.int64)
        codes = np.where(np.arange(MAX_WORDS) < length[:, None], rows[at], np.uint64(0)).astype(np.int64)
        yield pa.record_batch(
            [*(pa.array(c.copy()) for c in codes.T), pa.array(length.astype(np.int32)), pa.array([f[2] for f in found], pa.int64())],
            [*_CODES, "n_words", "a"])

    columns = ", ".join(f"{c} long" for c in _CODES)
    parts = packed.groupBy("bucket").applyInArrow(sort, f"{columns}, n_words int, a long")
    return parts.groupBy(*_CODES, "n_words").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _part(start: int | Column, length: int | Column) -> Column:
    """The numbers of a part of a phrase, as an array."""
    return F.slice("codes", start, length)


def scored(phrases: DataFrame, words: DataFrame, covered: int = COVERED) -> DataFrame:
    """(codes, a, l, r, score) of the phrases that no longer one covers, by their lowest cut.

    ``phrases`` (codes, a) and ``words`` (code, n) hold every part of every phrase. A longer phrase that
    covers another has one of one word more between them, which covers it as well; so only those are met.
    """
    longer = phrases.where(F.size("codes") > 2).select("a", F.explode(F.array(
        _part(1, F.size("codes") - 1), _part(2, F.size("codes") - 1))).alias("codes")).groupBy("codes").agg(F.max("a").alias("around"))
    kept = phrases.join(longer, "codes", "left").where(F.col("around").isNull() | (100 * F.col("around") < covered * F.col("a")))
    cuts = kept.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k"))
    counts = phrases.select("codes", "a").unionByName(words.select(F.array("code").alias("codes"), F.col("n").alias("a")))
    left = counts.select(F.col("codes").alias("first"), F.col("a").alias("l"))
    right = counts.select(F.col("codes").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.select("*", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.size("codes") - F.col("k")).alias("rest"))
    cuts = cuts.join(left, "first").join(right, "rest")
    # Decimals, as the product may exceed 64 bits; ``div`` gives the whole part.
    score = F.expr(f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) div CAST(l + r AS DECIMAL(20, 0))")
    lowest = cuts.select("codes", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    return lowest.groupBy("codes", "a").agg(F.min("cut").alias("cut")).select("codes", "a", "cut.l", "cut.r", "cut.score")


def spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with lang and phrase, their words joined by a space, instead of codes."""
    places = phrases.select("*", F.posexplode("codes").alias("place", "code"))
    found = places.join(words.select("code", "lang", "word"), "code")
    rest = [c for c in phrases.columns if c != "codes"]
    return found.groupBy("codes", *rest).agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("spelled")) \
        .select(*rest, "lang", F.array_join("spelled.word", " ").alias("phrase"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, first: int | None = FIRST, covered: int = COVERED
) -> DataFrame:
    """Per language the ``first`` phrases of 2 to MAX_WORDS words (all for None): lang, rank, phrase, a, l, r, n, score.

    A NULL language is `und`, a NULL or empty text has no words; repeated rows count each on their own.
    Other columns are ignored. Ties go to the more frequent phrase, then to the one first in UTF-8 order.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    every = written(word_counts(rows), "collocation-words")
    sizes = every.groupBy("lang").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    known, head = frequent_words(every, total, least)
    frequent = spark.sparkContext.broadcast(known)
    found = written(phrase_counts(routed(rows, frequent, total // BUCKET + 1), frequent, least), "collocation-phrases")
    phrases = found.select(F.slice(F.array(*_CODES), 1, F.col("n_words")).alias("codes"), "a")
    best = spelled(scored(phrases, head, covered), head).join(sizes, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order).cast("long"))
    if first is not None:
        best = best.where(F.col("rank") <= first)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
