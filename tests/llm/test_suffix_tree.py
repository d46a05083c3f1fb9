import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import suffix_tree
from jobmart.llm.suffix_tree import DEPTH, END, score_texts, symbols
from tests.llm import suffix_model
from tests.llm.conftest import prose
from tests.llm.suffix_model import Automaton, build, window_counts


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [prose(k % 30, 60) for k in range(80)]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 7 != 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, learn boolean")


def test_base_score(spark, corpus):
    rows = corpus.collect()
    count = Counter(w for r in rows if r.learn for w in tokens(r.text))
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in score_texts(corpus, "doc_id", "text", "learn").collect()}
    for r in rows:
        words = tokens(r.text)
        assert got[r.doc_id].base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words))
        assert got[r.doc_id].n_tokens == len(words)
        assert got[r.doc_id].n_known == sum(w in count for w in words)
        assert got[r.doc_id].train_tokens == n


def test_blocks_do_not_matter(corpus, monkeypatch):
    whole = sorted(score_texts(corpus, "doc_id", "text", "learn").collect())
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 2000)
    for a, b in zip(whole, sorted(score_texts(corpus, "doc_id", "text", "learn").collect())):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:])


def test_distributions_add_up_and_beat_the_base(corpus):
    model = build(window_counts(corpus, "text", "learn")[0])
    others = suffix_tree.SYMBOLS - (model.logp.shape[1] - 1)
    p = 10.0 ** model.logp.astype(float)
    np.testing.assert_allclose(p[:, :-1].sum(axis=1) + others * p[:, -1], 1, rtol=1e-4)
    assert len(model.step) > 100
    got = score_texts(corpus, "doc_id", "text", "learn").where("not learn" if False else "doc_id >= 0").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def one_by_one(model: Automaton, contents):
    """The automaton step by step, without strides."""
    read, starts = symbols([contents])
    state, total = 0, 0.0
    for k, byte in enumerate(read.tolist()):
        column = model.symbol[byte]
        if k >= DEPTH:
            total += float(model.logp[state, column])
        state = model.step[state, column]
    return total


def test_strides_and_states(corpus, monkeypatch):
    model = build(window_counts(corpus, "text", "learn")[0])
    texts = [r.text.encode() for r in corpus.limit(6).collect()] + [None, b"", b"\xff\x00 new", prose(5, 900).encode()]
    monkeypatch.setattr(suffix_model, "STRIDE", 37)
    np.testing.assert_allclose(model.score(texts), [one_by_one(model, t) for t in texts], rtol=1e-5)


def test_longest_suffix_state(spark):
    # After "ab" always "c", after "xb" always "d": the longer context decides.
    text = " ".join(["abc", "xbd"] * 300)
    docs = spark.createDataFrame([(1, text, True)], "doc_id long, text string, learn boolean")
    model = build(window_counts(docs, "text", "learn")[0])

    def p(before, symbol):
        state = 0
        for byte in bytes([END]) * DEPTH + before:
            state = model.step[state, model.symbol[byte]]
        return 10 ** model.logp[state, model.symbol[symbol[0]]]

    assert p(b"ab", b"c") > 0.98 and p(b"xb", b"d") > 0.98 and p(b"ab", b"d") < 0.01


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs):
        docs = docs.withColumn("learn", F.col("doc_id") != 2)
        got = score_texts(docs, "doc_id", "text", "learn").collect()
        assert len(got) == docs.count()
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)
        assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert score_texts(no_docs.withColumn("learn", F.lit(True)), "doc_id", "text", "learn").count() == 0


def test_nothing_to_learn_from(odd_docs):
    got = score_texts(odd_docs.withColumn("learn", F.lit(False)), "doc_id", "text", "learn").collect()
    empty = next(r for r in got if r.doc_id == 4)
    assert empty.score == pytest.approx(-math.log10(256), rel=1e-5)
    assert empty.train_tokens == 0 and empty.n_known == 0 and empty.base_score == 0


def test_spread_states_score_as_the_whole_tree(corpus, monkeypatch):
    model = build(window_counts(corpus, "text", "learn")[0])
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", 3000)
    rows = corpus.collect()
    got = {r.doc_id: r.score for r in score_texts(corpus, "doc_id", "text", "learn").collect()}
    want = model.score([r.text.encode() for r in rows])
    np.testing.assert_allclose([got[r.doc_id] for r in rows], want, rtol=1e-5)


def test_a_rare_context_stays_in_a_large_corpus(spark):
    # "qzv" is followed by "k" in 3 of 4 million places; a share of 2e-6 asked for 8.
    filler = prose(3, 2000)
    rows = [(i, filler, True) for i in range(400)] + [(1000 + i, "qzvk", True) for i in range(3)]
    docs = spark.createDataFrame([*rows, (2000, "qzvk", False), (2001, "qzvt", False)], "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in score_texts(docs, "doc_id", "text", "learn").where("doc_id >= 2000").collect()}
    assert got[2000] > got[2001] + 2
    places = sum(len(t) + 1 for _, t, _ in rows)
    assert 2e-6 * places > 3
    # Three of "q", each "z", "v", "k" and the end after it: the first letter only is a surprise.
    assert got[2000] > math.log10(3 / places) - 1.5


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_windows_are_counted_and_looked_up_by_sorting(n):
    codes = np.random.default_rng(3).integers(0, 1 << 55, 700)[np.arange(n) ** 2 % 700]
    known, times = suffix_tree.counted(codes)
    assert dict(zip(known.tolist(), times.tolist())) == Counter(codes.tolist())
    assert (np.diff(known) > 0).all()
    log = np.arange(len(known), dtype=np.float32)
    found = suffix_tree.looked_up(codes, known, log)
    assert found.dtype == float and (known[found.astype(int)] == codes).all()
