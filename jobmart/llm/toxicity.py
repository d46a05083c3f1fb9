"""Toxicity by the nearest labelled examples under TF-IDF cosine, found in a block-max inverted index.

Terms are words and beginnings of words; all terms of the examples span the vector space. A term's weight
in a text is its logarithmic count times its inverse document frequency, counted over all texts to learn
from, times a factor between FLOOR and 1 by which it tells the toxic examples from the others. A text is compared
to the examples exactly: the index has a posting list for each term, cut into blocks of examples with the
largest weight of each, so that a block's bound follows from its maxima; the best block is scored first, and then
those whose bound reaches the nearest found so far. The lists of the few terms that most examples hold are full, so
they are kept as a matrix and multiplied for a batch of texts at once; they count in full in the bounds. The neighbours vote by their nearness, and the votes are
calibrated on the examples themselves, each left out of its own vote.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import prepare, row_hash, same, written
from jobmart.llm.words import words

#: The classifier is fitted on this many labelled rows of each class at most.
EXAMPLES = 1000

#: Beginnings of words that count as terms, in characters.
BEGINNINGS = range(3, 9)

#: Neighbours that vote, and examples in a block of the index.
NEIGHBOURS, BLOCK = 15, 64

#: Most terms whose lists are kept as a matrix, and the share of the examples (one in so many) that must hold them.
FULL, FULL_SHARE = 512, 8

#: Weight of the prior among the votes.
PRIOR_VOTES = 0.5

#: Least factor of a term: that of terms which say nothing about the classes.
FLOOR = 0.002

_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_terms(distinct: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of each word, and the place of their word: it without marks around it, and its beginnings (with a star)."""
    core = pc.utf8_lower(pc.utf8_trim(distinct, _EDGE))
    length = pc.utf8_length(core).to_numpy()
    parts, places = [core.filter(pa.array(length > 0))], [np.flatnonzero(length > 0)]
    for k in BEGINNINGS:
        longer = np.flatnonzero(length > k)
        begun = pc.utf8_slice_codeunits(core.take(pa.array(longer)), 0, k)
        parts.append(pc.binary_join_element_wise(begun, pa.scalar("*", begun.type), pa.scalar("", begun.type)))
        places.append(longer)
    return pa.concat_arrays(parts), np.concatenate(places)


def terms_of(word: str) -> list[str]:
    return word_terms(pa.array([word], pa.large_string()))[0].to_pylist()


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of all ranges one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def term_counts(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the vocabulary's terms in each whole text, by row and term."""
    flat, at = words(texts)
    coded = flat.dictionary_encode()
    term, place = word_terms(coded.dictionary)
    found = pc.index_in(term, value_set=vocabulary)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    ids, place = found.filter(pa.array(known)).to_numpy().astype(np.int64), place[known]
    order = np.argsort(place, kind="stable")
    ids, per_word = ids[order], np.bincount(place, minlength=len(coded.dictionary))
    index = coded.indices.to_numpy()
    lengths = per_word[index]
    spoken = ids[_ranges((np.cumsum(per_word) - per_word)[index], lengths)]
    key, counts = np.unique(np.repeat(at, lengths) * max(1, len(vocabulary)) + spoken, return_counts=True)
    return *np.divmod(key, max(1, len(vocabulary))), counts


@dataclass
class Index:
    """Example vectors as posting lists by term, in blocks of BLOCK examples, with the maxima of each."""

    vocabulary: pa.Array
    #: Inverse document frequency times factor.
    weights: np.ndarray
    #: The cells of a term, one for each block with an example that has it, stand from ``cells[term]`` on.
    cells: np.ndarray
    #: Of each cell: its block, its largest value, and where its postings begin.
    block: np.ndarray
    most: np.ndarray
    first: np.ndarray
    examples: np.ndarray
    values: np.ndarray
    n_blocks: int
    #: Row of a term in ``full``, -1 for those with postings; and the weights there, by example.
    full_row: np.ndarray
    full: np.ndarray
    toxic: np.ndarray  # weight of each example if toxic, else 0
    other: np.ndarray
    ids: list[int | None]
    prior: float
    without_terms: float  # share of toxic examples among those without any term
    knots: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0, 1.0]), np.array([0.0, 1.0])))

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(counts)) * self.weights[at]
        return weight / np.linalg.norm(weight)

    def full_part(self, row: np.ndarray, at: np.ndarray, weight: np.ndarray, n_rows: int) -> np.ndarray:
        """What the terms with full lists add to the cosines of each row with each example."""
        some = self.full_row[at] >= 0
        spoken = np.zeros((n_rows, len(self.full)))
        spoken[row[some], self.full_row[at[some]]] = weight[some]
        return spoken @ self.full

    def nearest(
        self, at: np.ndarray, weight: np.ndarray, left_out: int | None = None, full: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Examples and their cosines, nearest first: the NEIGHBOURS nearest and what ties with them, exactly."""
        if full is None:
            full = self.full_part(np.zeros(len(at), np.int64), at, weight, 1)[0]
        rare = self.full_row[at] < 0
        at, weight = at[rare], weight[rare]
        lengths = self.cells[at + 1] - self.cells[at]
        cells, spread = _ranges(self.cells[at], lengths), np.repeat(weight, lengths)
        block = self.block[cells]
        most = np.maximum.reduceat(full, np.arange(0, len(full), BLOCK))
        bounds = most + np.bincount(block, self.most[cells] * spread, self.n_blocks)

        def cosines(chosen: np.ndarray) -> np.ndarray:
            """The cosine of every example in the chosen blocks; 0 for the others."""
            own = chosen[block]
            starts = self.first[cells[own]]
            n = self.first[cells[own] + 1] - starts
            places = _ranges(starts, n)
            rest = np.bincount(self.examples[places], self.values[places] * np.repeat(spread[own], n), len(self.ids))
            return rest + np.where(np.repeat(chosen, BLOCK)[:len(full)], full, 0.0)

        def least() -> float:
            own = np.delete(cosine, left_out) if left_out is not None else cosine
            return np.partition(own, -NEIGHBOURS)[-NEIGHBOURS] if len(own) > NEIGHBOURS else 0.0

        best = np.arange(self.n_blocks) == np.argmax(bounds)
        cosine = cosines(best)
        more = ~best & (bounds > max(least() - 1e-9, 0.0))
        if more.any():
            cosine += cosines(more)
        if left_out is not None:
            cosine[left_out] = 0.0
        found = np.flatnonzero((cosine > 0) & (cosine >= least() - 1e-12))
        found = found[np.argsort(-cosine[found], kind="stable")]
        return found, cosine[found]

    def votes(self, near: np.ndarray, cosine: np.ndarray) -> float:
        nearness = cosine**2
        for_ = PRIOR_VOTES * self.prior + nearness @ self.toxic[near]
        return for_ / (PRIOR_VOTES + nearness @ (self.toxic[near] + self.other[near]))

    def scores(self, row: np.ndarray, at: np.ndarray, counts: np.ndarray, empty: np.ndarray) -> Iterator[tuple[float, list[int | None]]]:
        """For each text its probability of being toxic, and the nearest examples' ids."""
        weight = (1 + np.log(counts)) * self.weights[at]
        norm = np.sqrt(np.bincount(row, weight**2, len(empty)))
        weight = weight / norm[row]
        full = self.full_part(row, at, weight, len(empty)) if len(self.ids) else None
        starts = np.searchsorted(row, np.arange(len(empty) + 1))
        for k, (a, b) in enumerate(zip(starts, starts[1:])):
            if empty[k]:
                yield self.without_terms, []
            elif a == b:
                yield self.prior, []
            else:
                near, cosine = self.nearest(at[a:b], weight[a:b], None, full[k])
                yield float(np.interp(self.votes(near, cosine), *self.knots)), [self.ids[e] for e in near[:3].tolist()]


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the weighted isotonic regression of y on x (pooling of adjacent violators)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, mean of x, mean of y
    for xi, yi, wi in zip(x[order], y[order], w[order]):
        pools.append([wi, xi, yi])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            b, a = pools.pop(), pools.pop()
            total = a[0] + b[0]
            pools.append([total, (a[0] * a[1] + b[0] * b[1]) / total, (a[0] * a[2] + b[0] * b[2]) / total])
    return np.array([0.0, *(p[1] for p in pools), 1.0]), np.array([pools[0][2], *(p[2] for p in pools), pools[-1][2]])


def _term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, n): in how many examples of a batch a term is."""
    for batch in batches:
        flat, at = words(batch.column(0))
        coded = flat.dictionary_encode()
        term, place = word_terms(coded.dictionary)
        term = term.dictionary_encode()
        own = pa.table({"word": coded.indices.to_numpy(), "row": at}).group_by(["word", "row"]).aggregate([])
        per_word = np.bincount(place, minlength=len(coded.dictionary))
        ids = term.indices.to_numpy()[np.argsort(place, kind="stable")]
        word = own["word"].to_numpy()
        lengths = per_word[word]
        spoken = ids[_ranges((np.cumsum(per_word) - per_word)[word], lengths)].astype(np.int64)
        key = np.unique(np.repeat(own["row"].to_numpy(), lengths) * max(1, len(term.dictionary)) + spoken)
        row, spoken = np.divmod(key, max(1, len(term.dictionary)))
        label = batch.column(1).to_numpy()[row]
        for toxic in (0, 1):
            n = np.bincount(spoken[label == toxic], minlength=len(term.dictionary))
            some = np.flatnonzero(n)
            yield pa.record_batch(
                [term.dictionary.take(pa.array(some)).cast(pa.string()), pa.array(np.full(len(some), toxic, np.int32)), pa.array(n[some].astype(np.int64))],
                ["term", "toxic", "n"])


def _drawn(texts: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str) -> tuple[DataFrame, dict[int, int]]:
    """The examples (doc_id, text, toxic), and how many labelled rows of each class there are.

    A class's examples are its EXAMPLES rows with the least hashes, so the draw does not depend on how the
    table is cut. Only hashes are joined with the labels; the texts of the drawn rows alone are fetched.
    """
    known = labels.where(F.col(toxic).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("doc_id")) \
        .agg(F.min(toxic).cast("int").alias("toxic"), F.max(toxic).alias("most")).where("toxic = most").drop("most")
    rows = texts.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row")).join(known, "doc_id").distinct()
    rows = written(rows, "toxicity-labelled")
    sizes = dict(rows.groupBy("toxic").count().collect())
    taken = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", "row"), "doc_id", "row").limit(EXAMPLES) for c in sorted(sizes)]
    if not taken:
        return texts.sparkSession.createDataFrame([], "doc_id long, text string, toxic int"), sizes
    chosen = taken[0].unionByName(taken[-1]) if len(taken) > 1 else taken[0]
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("toxic").alias("_toxic"))
    contents = texts.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"), F.col(text).alias("text"))
    on = same(contents["doc_id"], F.col("_id")) & (contents["row"] == F.col("_row"))
    found = contents.join(F.broadcast(chosen), on).dropDuplicates(["doc_id", "row"])  # 2 * EXAMPLES rows at most
    return written(found.select("doc_id", "text", F.col("_toxic").alias("toxic")), "toxicity-examples"), sizes


def factors(pos: np.ndarray, n: np.ndarray, positive: int, total: int) -> np.ndarray:
    """Per term between FLOOR and 1: its likelihood ratio, if it leans to toxic texts, against what one false term would reach.

    The power keeps the many terms that lean a little by chance from outweighing few that do for certain.
    """
    p = positive / max(1, total)
    neg = n - pos
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(pos > 0, pos * np.log(pos / (n * p)), 0.0) + np.where(neg > 0, neg * np.log(neg / (n * (1 - p))), 0.0))
    lean = np.where(pos > n * p, np.nan_to_num(ratio) / (2 * math.log(max(2, len(n)))), 0.0)
    return FLOOR + (1 - FLOOR) * np.clip(lean, 0.0, 1.0) ** 6


def document_frequencies(texts: DataFrame, vocabulary: pa.Array, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all ``texts`` each term of the vocabulary is, and how many texts there are; tasks add up their own."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            n += np.bincount(term_counts(batch.column(0), shared.value)[1], minlength=len(n))
            rows += len(batch)
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(np.append(some, -1)), pa.array(np.append(n[some], rows))], ["term", "n"])

    counts = texts.select(text).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(vocabulary) + 1, np.int64)
    n[counts["term"].to_numpy()] = counts["n"].to_numpy()  # a row a term, and the number of texts last
    return n[:-1], int(n[-1])


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", texts: DataFrame | None = None) -> Index:
    """The index of EXAMPLES labelled rows of each class at most, weighted back to their true shares.

    ``labelled`` holds labels by id, and the texts too unless ``texts`` (id, text) does. Every row of an id carries its
    label; rows repeated in full count once. Labels other than 0 and 1, ids that carry both, and rows without an id are
    not used. Without examples every text scores 0.
    """
    spark = labelled.sparkSession
    prepare(spark)
    texts = labelled if texts is None else texts
    drawn, sizes = _drawn(texts, labelled, doc_id, text, toxic)
    taken = dict(drawn.groupBy("toxic").count().collect())
    weight = np.array([sizes.get(c, 0) / max(1, taken.get(c, 0)) for c in (0, 1)])
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))

    by_term = drawn.select("text", "toxic").mapInArrow(_term_sets, "term string, toxic int, n long").groupBy("term") \
        .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum("n").alias("n")).orderBy("term").toArrow()
    vocabulary = by_term["term"].combine_chunks().cast(pa.large_string())
    vocabulary = vocabulary.combine_chunks() if isinstance(vocabulary, pa.ChunkedArray) else vocabulary
    shared = spark.sparkContext.broadcast(vocabulary)
    df, everyone = document_frequencies(texts, vocabulary, text)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, counts = term_counts(batch.column(2), shared.value)
            starts = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(starts, pa.array(v.astype(np.int32))) for v in (term, counts)]
            yield pa.record_batch([*batch.columns[:2], *lists], ["doc_id", "toxic", "terms", "counts"])

    sparse = drawn.select("doc_id", "toxic", "text").mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, counts array<int>")
    rows = sparse.toArrow()  # 2 * EXAMPLES rows at most
    label = rows["toxic"].to_numpy()
    terms = [t.values.to_numpy().astype(np.int64) for t in rows["terms"]]
    counts = [c.values.to_numpy() for c in rows["counts"]]
    with_terms = np.array([len(t) > 0 for t in terms], bool)
    silent = np.array([(~with_terms & (label == c)).sum() for c in (0, 1)]) * weight
    idf = np.log((1 + everyone) / (1 + df)) + 1
    lean = factors(by_term["pos"].to_numpy().astype(float), by_term["n"].to_numpy().astype(float), taken.get(1, 0), sum(taken.values()))
    keep = np.flatnonzero(with_terms)
    return _index(
        [terms[e] for e in keep], [counts[e] for e in keep], label[keep], [rows["doc_id"][int(e)].as_py() for e in keep], vocabulary, idf * lean,
        weight, prior, float((silent[1] + PRIOR_VOTES * prior) / (silent.sum() + PRIOR_VOTES)),
    )


def _index(
    terms: list[np.ndarray], counts: list[np.ndarray], label: np.ndarray, ids: list, vocabulary: pa.Array, weights: np.ndarray,
    weight: np.ndarray, prior: float, silent: float,
) -> Index:
    """``weight`` is how many labelled rows an example of each class stands for."""
    def heaviest(e: int) -> int:
        return int(terms[e][np.argmax((1 + np.log(counts[e])) * weights[terms[e]])])

    # Examples with the same heaviest term share blocks, which keeps the maxima low elsewhere.
    order = sorted(range(len(terms)), key=lambda e: (heaviest(e), e))
    terms, counts = [terms[e] for e in order], [counts[e] for e in order]
    label, ids = label[order] if len(order) else label, [ids[e] for e in order]
    n_blocks = max(1, -(-len(order) // BLOCK))
    none = np.empty(0, np.int64)
    index = Index(
        vocabulary, weights, none, none, none, none, none, none, n_blocks, np.full(len(weights), -1), np.zeros((0, len(order))),
        np.where(label == 1, weight[1], 0.0), np.where(label == 0, weight[0], 0.0), ids, prior, silent,
    )
    values = [index.vector(t, c) for t, c in zip(terms, counts)]
    term = np.concatenate([*terms, none])
    example = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    value = np.concatenate([*values, np.empty(0)])
    held = np.bincount(term, minlength=len(weights))
    often = np.argsort(-held, kind="stable")[:FULL]
    often = often[held[often] * FULL_SHARE > len(order)]
    index.full_row[often] = np.arange(len(often))
    index.full = np.zeros((len(often), len(order)))
    full = index.full_row[term] >= 0
    index.full[index.full_row[term[full]], example[full]] = value[full]
    term, example, value = term[~full], example[~full], value[~full]
    by_cell = np.lexsort((example, term))
    term, example, value = term[by_cell], example[by_cell], value[by_cell]
    key = term * n_blocks + example // BLOCK
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    index.cells = np.searchsorted(term[starts], np.arange(len(weights) + 1)).astype(np.int32)
    index.block = (example[starts] // BLOCK).astype(np.int32)
    index.most = np.maximum.reduceat(value, starts) if len(starts) else value
    index.first = np.append(starts, len(term)).astype(np.int32)
    index.examples, index.values = example.astype(np.int32), value
    if len(terms):
        votes = [index.votes(*index.nearest(t, v, e)) for e, (t, v) in enumerate(zip(terms, values))]
        index.knots = monotone(np.array(votes), (label == 1).astype(float), index.toxic + index.other)
    return index


def toxicity_of(spark: SparkSession, index: Index) -> Callable[[Column], Column]:
    """A column function: struct of score (0 to 1) and evidence (ids of the nearest examples).

    Whole texts are read. NULL and empty texts, and texts of marks alone, get the share of toxic
    examples among examples of that kind; texts of unknown words alone that among all.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("score double, evidence array<long>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            given = pa.Array.from_pandas(texts, type=pa.string())
            row, term, counts = term_counts(given, model.vocabulary)
            empty = np.array([not (t and t.strip(_EDGE + " \t\n\r\v\f")) for t in given.to_pylist()], bool)
            found = list(model.scores(row, term, counts, empty))
            yield pd.DataFrame({"score": [f[0] for f in found], "evidence": [f[1] for f in found]})

    return predict
