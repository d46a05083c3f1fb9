import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobmart.llm import resampling
from jobmart.llm.resampling import importance, resampled
from tests.llm.conftest import DOCUMENTS, prose


def expected(docs, target, max_words=1, least_words=20, percent=10):
    """(doc_id, n_features, weight, score, rank) by rows, in plain Python; ties broken by id."""
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [
            zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]

    own = [features(t) for _, t in docs]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000.0) / ((s[b] + 1.0) * (t_all + 10000.0)))) for b in s}
    rows = []
    for (doc_id, _), (n_words, f) in zip(docs, own):
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    may = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(may[:percent * len(may) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, prose(k, 5 + k % 60) + " " + prose(7, 9)) for k in range(300)]
    target = [prose(7, 40), prose(8, 40), None, ""]
    return rows, target, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string")


@pytest.mark.parametrize("max_words", [1, 2, 3])
@pytest.mark.parametrize("head", [1 << 16, 40, 1])
def test_same_as_brute_force(corpus, monkeypatch, max_words, head):
    # A head of many words, of a few, and of none: the totals do not depend on it.
    monkeypatch.setattr(resampling, "HEAD", head)
    rows, target, docs, wanted = corpus
    assert got(importance(docs, wanted, max_words=max_words)) == expected(rows, target, max_words)


def test_frequent_pairs_are_in_the_head(corpus, monkeypatch):
    monkeypatch.setattr(resampling, "HEAD", 200)
    _, _, docs, _ = corpus
    resampling.prepare(docs.sparkSession)
    head = resampling.head_of(docs.select("text"), 2)
    words = head.words.to_pylist()
    assert 0 < len(words) <= 200 and 0 < len(head.pairs) <= 200
    for pair, state in zip(head.pairs.tolist(), head.pair_states.tolist()):
        assert state == zlib.crc32(f"{words[pair // len(words)]} {words[pair % len(words)]}".encode())


def test_odd_rows(spark, odd_docs, clashing_docs):
    target = spark.createDataFrame([("the quick brown fox",)], "text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = expected(rows, ["the quick brown fox"], least_words=1, percent=50)
    for docs in (odd_docs, clashing_docs.withColumns({c: F.lit("x") for c in ("weight", "rank", "bucket", "place")})):
        assert got(importance(docs, target, least_words=1, percent=50)) == want
        drawn = resampled(docs, target, least_words=1, percent=50)
        assert drawn.columns == docs.columns
        ids = sorted((r.doc_id for r in drawn.collect()), key=str)
        assert {str(r[0]) for r in want if r[4]} == set(map(str, ids))


def test_empty_tables(spark, no_docs, corpus):
    _, target, docs, wanted = corpus
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert importance(no_docs, wanted).count() == 0
    assert got(importance(docs, wanted.limit(0))) == expected(rows, [])
    assert importance(no_docs, wanted.limit(0)).count() == resampled(no_docs, wanted).count() == 0


def test_long_text_and_ties(spark):
    rows = [(k // 2, prose(1, 25)) for k in range(40)] + [(100, prose(2, 80_000))]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCUMENTS)
    found = importance(docs, spark.createDataFrame([(prose(1, 5),)], "text string"), percent=100)
    assert got(found.drop("rank").withColumn("rank", F.lit(None))) == [(*r[:4], None) for r in expected(rows, [prose(1, 5)], percent=0)]
    assert sorted(r.rank for r in found.collect()) == list(range(1, 42))
