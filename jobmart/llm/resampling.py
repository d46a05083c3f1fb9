"""Importance resampling towards a target: hashed word features, a head and a tail of the vocabulary.

Features are runs of 1 to ``max_words`` words, a feature's bucket the CRC-32 of its bytes modulo BUCKETS.
Words that make up a stated share of the corpus are counted exactly and broadcast with the CRC state in
which they leave the checksum, and pairs of such words with theirs; their number is bounded by the share.
Any other feature is rare: its checksum is taken directly, from the state of the run before its last word
on. Both ways give the same buckets, so bucket totals are exact and follow from no sample.

A document's weight is the sum of its features' gains, the scaled log ratio of target and corpus in their
buckets. Gumbel noise drawn from a hash of the document's id turns the weights into a draw without
replacement: the highest sums are drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import prepare, row_hash, same, written
from jobmart.llm.words import NO_LETTER_OR_DIGIT, cut

#: Buckets of features, and units of a gain in the natural logarithm.
BUCKETS, UNITS = 10_000, 1000

#: A word, and a pair of words, is frequent if it is one in HEAD of all: so HEAD of each at most are broadcast.
HEAD = 1 << 16

#: Longest features in words, words a document needs to be drawn, and documents drawn of a hundred of those.
MAX_WORDS, LEAST_WORDS, PERCENT = 1, 20, 10

#: Prefix of what is hashed for the noise.
SEED = "2024:"


@dataclass
class Head:
    """Frequent words with their CRC states, and frequent pairs of them with theirs."""

    words: pa.Array
    states: np.ndarray
    #: Sorted ``first * len(words) + second``, and the states after these pairs.
    pairs: np.ndarray
    pair_states: np.ndarray

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Index of each word among the frequent ones; -1 for the others."""
        return pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy().astype(np.int64)


@dataclass
class Cut:
    """The words of a batch of texts: distinct ones, their places in the head, the word and row at each position."""

    distinct: pa.Array
    places: np.ndarray
    index: np.ndarray
    rows: np.ndarray


def _cut(texts: pa.Array, head: Head) -> Cut:
    flat, rows, _ = cut(texts, NO_LETTER_OR_DIGIT)
    coded = flat.dictionary_encode()
    return Cut(coded.dictionary, head.places(coded.dictionary), coded.indices.to_numpy().astype(np.int64), rows)


def runs(own: Cut, head: Head, max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of a feature: the row and the CRC-32 of every run of so many words."""
    if not len(own.index):
        return
    tail = np.flatnonzero(own.places < 0)
    state = head.states[own.places] if len(head.states) else np.zeros(len(own.places), np.int64)
    state[tail] = [zlib.crc32(w) for w in own.distinct.take(pa.array(tail)).cast(pa.large_binary()).to_pylist()]
    run, starts = own.index, np.arange(len(own.index))  # the distinct run at each place where one begins
    yield own.rows, state[run]
    for length in range(2, max_words + 1):
        last = starts + length - 1
        fits = last < len(own.index)
        fits[fits] = own.rows[last[fits]] == own.rows[starts[fits]]
        starts = starts[fits]
        key = run[fits] * len(own.distinct) + own.index[last[fits]]
        distinct, run = np.unique(key, return_inverse=True)
        before, word = np.divmod(distinct, len(own.distinct))
        following = np.full(len(distinct), -1, np.int64)
        if length == 2 and len(head.pairs):
            both = (own.places[before] >= 0) & (own.places[word] >= 0)
            pair = np.where(both, own.places[before] * len(head.words) + own.places[word], -1)
            at = np.minimum(np.searchsorted(head.pairs, pair), len(head.pairs) - 1)
            following = np.where(head.pairs[at] == pair, head.pair_states[at], -1)
        rest = np.flatnonzero(following < 0)
        texts = own.distinct.take(pa.array(word[rest])).cast(pa.large_binary()).to_pylist()
        following[rest] = [zlib.crc32(b" " + w, s) for w, s in zip(texts, state[before[rest]].tolist())]
        state = following
        yield own.rows[starts], state[run]


def _counts(df: DataFrame, head: Head, pairs: bool) -> DataFrame:
    """(feature, n): words, or pairs of frequent words as their number, a row for each batch they are in."""
    shared = df.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _cut(batch.column(0), shared.value)
            if pairs:
                place = own.places[own.index]
                fits = (own.rows[1:] == own.rows[:-1]) & (place[1:] >= 0) & (place[:-1] >= 0)
                found, n = np.unique((place[:-1] * len(shared.value.words) + place[1:])[fits], return_counts=True)
                feature = pa.array(found, pa.int64())
            else:
                n, feature = np.bincount(own.index, minlength=len(own.distinct)), own.distinct.cast(pa.string())
            yield pa.record_batch([feature, pa.array(n.astype(np.int64))], ["feature", "n"])

    return df.mapInArrow(count, f"feature {'long' if pairs else 'string'}, n long")


def _frequent(counts: DataFrame, purpose: str) -> list:
    """The features that make up a share of 1 / HEAD of all ``counts`` at least, HEAD of them at most."""
    counts = written(counts.groupBy("feature").agg(F.sum("n").alias("n")), purpose)
    total = counts.agg(F.sum("n")).first()[0] or 0
    return sorted(r[0] for r in counts.where(F.col("n") * HEAD >= total).select("feature").collect())


def head_of(texts: DataFrame, max_words: int = MAX_WORDS) -> Head:
    """The frequent words of all ``texts`` (one column), and the frequent pairs if features have two words."""
    none = Head(pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    words = _frequent(_counts(texts, none, False), "resampling-words")
    head = Head(pa.array(words, pa.large_string()), np.array([zlib.crc32(w.encode()) for w in words], np.int64), none.pairs, none.pair_states)
    if max_words > 1 and words:
        pairs = _frequent(_counts(texts, head, True), "resampling-pairs")
        states = [zlib.crc32(b" " + words[p % len(words)].encode(), int(head.states[p // len(words)])) for p in pairs]
        head.pairs, head.pair_states = np.array(pairs, np.int64), np.array(states, np.int64)
    return head


def bucket_totals(texts: DataFrame, head: Broadcast, max_words: int = MAX_WORDS) -> np.ndarray:
    """How many features of all ``texts`` (one column) are in each bucket: every task adds up its own."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, crc in runs(_cut(batch.column(0), head.value), head.value, max_words):
                totals += np.bincount(crc % BUCKETS, minlength=BUCKETS)
        used = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(totals[used])], ["bucket", "n"])

    totals = np.zeros(BUCKETS, np.int64)
    for bucket, n in texts.mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # BUCKETS at most
        totals[bucket] = n
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(UNITS * ln of the smoothed target share over the smoothed corpus share) of each bucket."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(UNITS * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def noise(doc_id: Column) -> Column:
    """Gumbel noise in units of a gain, from the first 32 bits of a hash of the id; a row without id hashes the seed alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1.0 * UNITS * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weights(docs: DataFrame, doc_id: str, text: str, head: Broadcast, gain: np.ndarray, max_words: int) -> DataFrame:
    """(doc_id, row, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _cut(batch.column(2), head.value)
            n, weight = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for rows, crc in runs(own, head.value, max_words):
                n += np.bincount(rows, minlength=len(batch))
                weight += np.bincount(rows, shared.value[crc % BUCKETS], len(batch)).astype(np.int64)  # exact below 2 ** 53
            n_words = np.bincount(own.rows, minlength=len(batch)).astype(np.int64)
            yield pa.record_batch(
                [*batch.columns[:2], pa.array(n_words), pa.array(n), pa.array(weight)], ["doc_id", "row", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, row long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rows`` (a written table) with ``rank``: 1, 2, 3, ... over the drawn ones by falling score, NULL for the others.

    The rows that may be drawn are dealt out by ranges of their order; a row's rank is its place in its
    range and the number of rows in the ranges before, one number a range. Ties go to the smaller id, rows
    without id come last.
    """
    spark = rows.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    may = rows.where(F.col("n_words") >= least_words)
    total = may.count()
    draw = percent * total // 100
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # A range of its own partition: the number holds the partition in its upper bits, the place in the lower 33.
    dealt = written(
        may.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "resampling-order",
    )
    part = F.shiftright("place", 33)
    before, so_far = [], 0
    for p, n in sorted(dealt.groupBy(part.alias("p")).count().collect()):  # one row a range
        before.append((p, so_far))
        so_far += n
    ahead = spark.createDataFrame(before, "p long, ahead long")
    place = F.col("ahead") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    drawn = dealt.withColumn("p", part).join(F.broadcast(ahead), "p").withColumn("rank", F.when(place <= draw, place)).drop("p", "place", "ahead")
    rest = rows.where(~(F.col("n_words") >= least_words)).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)


def importance(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    max_words: int = MAX_WORDS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """Per row of ``docs``: doc_id, row, n_words, n_features, weight, score, rank (NULL if not drawn).

    A NULL or empty text has no features and weight 0, and is drawn only if ``least_words`` is 0. Repeated
    rows count and rank each on their own; equal scores rank by id, rows without id last. Without any
    target every bucket's gain shows its corpus share alone. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    corpus = docs.select(text)
    head = context.broadcast(head_of(corpus, max_words))
    gain = gains(bucket_totals(corpus, head, max_words), bucket_totals(target.select(target_text), head, max_words))
    scored = weights(docs, doc_id, text, head, gain, max_words).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    return ranked(written(scored, "resampling-scores"), least_words, percent)


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The drawn rows of ``docs`` with their columns as they are; a row repeated in full goes with its drawn copy."""
    drawn = importance(docs, target, doc_id, text, **settings).where("rank IS NOT NULL")
    drawn = drawn.select(F.col("doc_id").alias("_drawn_id"), F.col("row").alias("_drawn_row")).distinct()
    on = same(docs[doc_id].cast("long"), drawn["_drawn_id"]) & (row_hash(doc_id, text) == drawn["_drawn_row"])
    return docs.join(drawn, on, "left_semi")
