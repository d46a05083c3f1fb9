import itertools
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from jobmart.llm import near_dedup
from jobmart.llm.components import components
from jobmart.llm.near_dedup import drop_near_duplicates, near_groups
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def expected(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                of[root(i)] = root(j)
    low = defaultdict(lambda: (True, 0))
    for i, (doc_id, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), (True, 1 << 60)), (doc_id is None, doc_id or 0))
    return sorted(
        ((d, len(s), None if low[root(i)][0] else low[root(i)][1]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def family(seed, copies, words, changes):
    rng = random.Random(seed)
    base = prose(seed, words).split()
    for _ in range(copies):
        own = list(base)
        for _ in range(changes):
            own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
        yield " ".join(own)


@pytest.fixture(scope="module")
def copies(spark):
    texts = [t for k in range(12) for t in family(k, 6, 90, k // 2)] + [prose(100 + k, 40) for k in range(60)]
    # A chain: each is close to the next, the ends are far apart.
    chain = prose(77, 200).split()
    for k in range(12):
        texts.append(" ".join(chain))
        chain[k * 16 % 200] = f"x{k}"
        chain[(k * 16 + 8) % 200] = f"y{k}"
    random.Random(4).shuffle(texts)
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize("size", [4, 5])
def test_same_as_brute_force(copies, size):
    rows = [tuple(r) for r in copies.collect()]
    got = near_groups(copies, size=size)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == expected(rows, size)
    assert got.where("kept != (doc_id = component_id)").count() == 0


def test_weak_bands(copies):
    # Single words at 60 percent: many classes that are not linked share tables and have to be told apart.
    rows = [tuple(r) for r in copies.collect()]
    got = near_groups(copies, size=1, percent=60)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == expected(rows, 1, 60)


def test_many_copies_just_under_the_bound(spark, monkeypatch):
    """3,000 copies, each with 4 words of its own at 4 of 49 places whose shingles do not overlap.

    Copies with 3 places in common have a similarity of 0.816, with 2 of 0.783, with none of 0.72.
    """
    rng, base = random.Random(9), prose(5, 200).split()
    places, rows = [], []
    for k in range(3000):
        places.append(sorted(rng.sample(range(4, 200, 4), 4)))
        own = list(base)
        for p in places[-1]:
            own[p] = f"own{k}x{p}"
        rows.append((k, " ".join(own)))
    of, seen = list(range(3000)), {}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for k, own in enumerate(places):
        for three in itertools.combinations(own, 3):
            low, high = sorted((root(k), root(seen.setdefault(three, k))))
            of[high] = low
    want = {k: root(k) for k in range(3000)}
    assert 100 < len(set(want.values())) < 3000
    looked_at = []
    keep = near_dedup.similar

    def counted(pairs, sets, percent):
        looked_at.append(pairs.count())
        return keep(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "similar", counted)
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=4)
    found = dict(got.select("doc_id", "component_id").collect())
    assert found == want
    assert looked_at[0] < 3000 * 2999 / 2 / 5  # copies that share two places are hard to tell apart beforehand


def test_odd_rows(odd_docs, clashing_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = expected(rows, 4)
    for docs in (odd_docs, clashing_docs):
        got = near_groups(docs, size=4)
        assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == want
        kept = drop_near_duplicates(docs, size=4)
        assert kept.columns == docs.columns
        assert kept.where("doc_id IN (1, 2)").count() == 1
        assert kept.where("text IS NULL").count() == 2  # empty sets are linked with nothing


def test_heavy_group(spark):
    docs = spark.range(2000).selectExpr(
        "id AS doc_id", "if(id % 2 = 0, concat(repeat('the same words again and again ', 4), 'a b c d e f g h i ', id), concat('other ', id, ' x', id)) AS text")
    got = near_groups(docs, size=4)
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id < 6").collect()]
    assert expected(rows, 4)[2][2] == 0
    assert got.where("component_id = 0").count() == 1000


def test_components_of_a_path(spark):
    edges = spark.range(40).selectExpr("id AS a", "id + 1 AS b").union(spark.range(100, 103).selectExpr("id AS a", "200L AS b"))
    got = dict(components(edges).collect())
    assert {n for n, c in got.items() if c == 0} == set(range(41))
    assert {n for n, c in got.items() if c == 100} == {100, 101, 102, 200}


def test_no_rows(no_docs):
    assert near_groups(no_docs).count() == drop_near_duplicates(no_docs).count() == 0


def test_components_of_odd_edges(spark):
    schema = "a long, b long"
    assert components(spark.createDataFrame([], schema)).count() == 0
    edges = spark.createDataFrame([(1, 1), (2, None), (None, 3), (None, None), (5, 4), (5, 4), (4, 5)], schema)
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (4, 4), (5, 4)]


def test_words_of_a_slice(odd_docs):
    texts = pa.array([r.text for r in odd_docs.collect()])
    whole = near_dedup.shingle_sets(texts, 4)
    for start in (1, 7):
        part = near_dedup.shingle_sets(texts.slice(start), 4)
        assert all((a == b).all() for a, b in zip(whole[start:], part, strict=True))
