"""Language identification by rank-order profiles of character n-grams.

A language's profile lists its most frequent n-grams of one to three letters, words being padded by a
blank. A document's own list is compared to each profile by the out-of-place distance: the sum, over
the document's n-grams, of how far their ranks differ, a missing one costing the full length.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import prepare

#: Length of a profile, and of a document's list.
RANKS = 300

#: Stands around and between words; no letter has this code.
BLANK = 1

#: Distinct n-grams that a training task holds before it hands on partial counts.
HELD = 2_000_000

NO_LANGUAGE = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Lower-cased text's code points: the code itself for a letter, else the blank."""
    table = np.full(sys.maxunicode + 1, BLANK, np.uint32)
    codes = [c for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
    table[codes] = codes
    return table


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of the text, 21 bits a letter; empty without a letter."""
    if not text:
        return np.empty(0, np.int64)
    raw = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    codes = _letters()[np.frombuffer(raw, "<u4")].astype(np.int64)
    codes = codes[np.r_[True, (codes[1:] != BLANK) | (codes[:-1] != BLANK)]]  # one blank between words
    if len(codes) < 3:
        return np.empty(0, np.int64)
    pairs = (codes[:-1] << 21) | codes[1:]
    triples = ((pairs[:-1] << 21) | codes[2:])[codes[1:-1] != BLANK]  # none reaches over a word's end
    return np.concatenate([codes[codes != BLANK], pairs, triples])


def ranked(grams: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, equally frequent ones by code."""
    found, counts = np.unique(grams, return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:RANKS]]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, starts = np.unique(keys[order], return_index=True)
    return keys, np.add.reduceat(counts[order], starts)


def profiles(labelled: DataFrame, lang: str = "lang", text: str = "text") -> dict[str, np.ndarray]:
    """The ranked n-grams of each language, counted over all rows with a language and a letter.

    What reaches the driver is RANKS codes a language.
    """
    prepare(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def release() -> Iterator[pa.RecordBatch]:
            for language, parts in held.items():
                codes, counts = _merged(parts)
                for at in range(0, len(codes), 100_000):
                    some = slice(at, at + 100_000)
                    yield pa.record_batch(
                        [pa.array([language] * len(codes[some])), pa.array(codes[some]), pa.array(counts[some])],
                        ["lang", "gram", "n"],
                    )
            held.clear()

        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for language, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(language, []).append(ngrams(content))
            for language, grams in texts.items():
                parts = held.setdefault(language, [])
                parts.append(np.unique(np.concatenate(grams), return_counts=True))
                if len(parts) > 8:
                    held[language] = [_merged(parts)]
            if sum(len(codes) for parts in held.values() for codes, _ in parts) > HELD:
                yield from release()
        yield from release()

    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL")
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKS)
    found: dict[str, list[tuple[int, int]]] = {}
    for language, gram, rank in top.select("lang", "gram", "rank").collect():
        found.setdefault(language, []).append((rank, gram))
    return {k: np.array([g for _, g in sorted(v)], np.int64) for k, v in sorted(found.items())}


class Classifier:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, learned: dict[str, np.ndarray]):
        self.languages = sorted(learned)
        self.grams = np.unique(np.concatenate([*learned.values(), np.empty(0, np.int64)]))
        self.ranks = np.full((len(learned), len(self.grams) + 1), -1, np.int64)
        for k, language in enumerate(self.languages):
            self.ranks[k, np.searchsorted(self.grams, learned[language])] = np.arange(len(learned[language]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The nearest language (the first by name of equally near ones), and how near it is from 0 to 1."""
        own = ranked(ngrams(text))
        if not len(own) or not self.languages:
            return NO_LANGUAGE, 0.0
        at = np.searchsorted(self.grams, own)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != own] = len(self.grams)
        theirs = self.ranks[:, at]
        apart = np.where(theirs < 0, RANKS, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
        best = int(apart.argmin())
        return self.languages[best], float(1 - apart[best] / (RANKS * len(own)))


def language_of(spark: SparkSession, learned: dict[str, np.ndarray]) -> Callable[[Column], Column]:
    """A column function: struct of lang_pred and score for a whole text.

    A text without a letter (NULL and empty ones too), or without any learned language, is ``und``
    with score 0.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(learned)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = Classifier(shared.value)
        for texts in batches:
            yield pd.DataFrame([classify(t) for t in texts], columns=["lang_pred", "score"])

    return predict
