import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmart.llm import packing
from jobmart.llm.packing import Bins, crossover, cut, evolve, fitness, mutated, pack, pack_documents
from jobmart.llm.vocabularies import PACKING_ENCODING
from tests.llm.test_token_store import plain


def check(items, bins, capacity):
    fill = np.bincount(bins, weights=items)
    assert (fill <= capacity).all() and (fill > 0).all()


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(1, 99), min_size=2, max_size=60), st.integers(0, 9))
def test_children_are_packings(lengths, seed):
    lengths, rng = np.array(lengths), np.random.default_rng(seed)
    a = packing.placed(np.arange(len(lengths)), lengths, np.full(len(lengths), -1), Bins(100, 0))
    b = packing.placed(np.argsort(-lengths), lengths, np.full(len(lengths), -1), Bins(100, 0))
    for child in (crossover(a, b, lengths, 100, rng), mutated(a, lengths, 100, rng), evolve(lengths, [a], 100, rng)):
        check(lengths, child, 100)
    assert fitness(evolve(lengths, [a], 100, rng), lengths, 100) <= fitness(a, lengths, 100)


def test_whole_bins_survive_the_crossover():
    lengths = np.array([60, 40, 50, 50, 70, 20])
    a, b = np.array([0, 1, 0, 2, 3, 1]), np.array([0, 0, 1, 1, 2, 2])
    child = crossover(a, b, lengths, 110, np.random.default_rng(1))
    check(lengths, child, 110)


def test_near_the_lower_bound(spark):
    rng = np.random.default_rng(7)
    lengths = np.minimum(rng.lognormal(6, 1, 4000).astype(int) + 1, 2048)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "uid long, length long")
    rows = pack(items, 2048).collect()
    assert len(rows) == len(lengths)
    assert len({r.sequence_id for r in rows}) <= 1.01 * -(-lengths.sum() // 2048)


def test_optimum_of_a_hard_case():
    # Best fit decreasing needs 4 bins; three are possible.
    lengths = np.array([5, 5, 4, 4, 4, 4, 2, 2])
    assert evolve(lengths, [], 10, np.random.default_rng(0)).max() + 1 == 3


def test_cut():
    assert cut(5, 10) == [(0, 5)]
    assert cut(10, 10) == [(0, 10)]
    assert cut(25, 10) == [(0, 5), (5, 10), (15, 10)]
    assert cut(20, 10) == [(0, 10), (10, 10)]


def test_every_token_has_its_place(odd_docs, clashing_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = sorted(
        ((i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for i, t in rows
         for ids in [plain(PACKING_ENCODING, t)] for k, (s, n) in enumerate(cut(len(ids), 64))), key=str)
    for docs in (odd_docs, clashing_docs):
        got = pack_documents(docs, PACKING_ENCODING, 64).collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want
        places = {}
        for r in got:
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for spans in places.values():
            spans.sort()
            ends = np.cumsum([0, *(n for _, n in spans)])
            assert [o for o, _ in spans] == ends[:-1].tolist() and ends[-1] <= 64


def test_pools_are_separate(spark, monkeypatch):
    monkeypatch.setattr(packing, "POOL_ITEMS", 50)
    items = spark.range(400).selectExpr("id AS uid", "1 + id % 90 AS length")
    rows = pack(items, 100).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + 1 + r.uid % 90
    assert len(rows) == 400 and max(fill.values()) <= 100


def test_no_rows(no_docs):
    assert pack_documents(no_docs, PACKING_ENCODING, 64).count() == 0
