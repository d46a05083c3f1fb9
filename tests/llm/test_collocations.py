import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import collocations as mod
from jobmart.llm.collocations import collocations, counted
from tests.llm.conftest import prose


def expected(rows, least, first=2000):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            counts.update((lang, tuple(words[i:i + n])) for n in range(1, 5) for i in range(len(words) - n + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    around = Counter()
    for (lang, phrase), a in candidates.items():
        for n in range(2, len(phrase)):
            for i in range(len(phrase) - n + 1):
                key = lang, phrase[i:i + n]
                around[key] = max(around[key], a)
    by_lang = {}
    for (lang, phrase), a in candidates.items():
        if 100 * around[lang, phrase] >= 80 * a:
            continue
        cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    return sorted(
        (lang, rank + 1, phrase.decode(), -a, left, right, sizes[lang], -score)
        for lang, found in by_lang.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first]))


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = "the of and Zü zä new york city hall is x a".split()
    rows = []
    for k in range(500):
        out = [rng.choice(words) + rng.choice(["", "", "", "", ",", ".", "\n", "\t", "  "]) for _ in range(rng.randrange(60))]
        if k % 3 == 0:
            out[len(out) // 2:len(out) // 2] = ["as", "a", "matter", "of", "fact", "we", "say"]
        rows.append((rng.choice(["en", "de", None, "und"]), " ".join(out)))
    return rows


@pytest.mark.parametrize("least, heavy, head, bucket, chunk", [
    (30, 1000, 1 << 16, 500_000, 1_000_000), (5, 1000, 1 << 16, 300, 700), (5, 8, 40, 200, 500), (3, 20, 1, 100, 100),
])
def test_same_as_brute_force(spark, texts, monkeypatch, least, heavy, head, bucket, chunk):
    # Many buckets and chunks, few heavy words or most, all words by rank or none.
    for name, value in (("HEAVY", heavy), ("BUCKET", bucket), ("CHUNK", chunk), ("HEAD", head)):
        monkeypatch.setattr(mod, name, value)
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    assert got(collocations(docs, least=least)) == expected(texts, least)
    assert got(collocations(docs, least=least, first=7)) == expected(texts, least, 7)


@pytest.mark.parametrize("seed", range(3))
def test_three_way_quicksort_counts(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(1, 9, (3000, 4)).astype(np.uint64)
    ends = rng.integers(2, 5, 3000)
    rows[np.arange(4) >= ends[:, None]] = 0
    counts = rng.integers(1, 4, 3000)
    want = Counter()
    for row, n, c in zip(rows.tolist(), ends.tolist(), counts.tolist()):
        for k in range(2, n + 1):
            want[tuple(row[:k])] += c
    for heavy in (0, 3):
        found = [(tuple(rows[at, :k].tolist()), n) for at, k, n in counted(rows, counts, 40, heavy)]
        assert len(found) == len(dict(found)) and all(want[p] == n for p, n in found)
        assert {p for p, n in want.items() if n >= 40} <= set(dict(found))
        assert all(n >= 40 or all(w <= heavy for w in p[:len(p)]) and len(p) < 4 for p, n in found)


def test_odd_rows(spark, odd_docs, clashing_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    want = expected(rows, 2)
    assert want
    clashing = clashing_docs.withColumns({c: F.lit("x") for c in ("n", "a", "l", "r", "codes", "word", "rank", "phrase", "code")})
    assert got(collocations(odd_docs, least=2)) == got(collocations(clashing, least=2)) == want


def test_one_passage_everywhere(spark):
    line = "one line stands in very many documents and is heavy"
    rows = [("en", f"{line}. {prose(k, 5)} {line}") for k in range(2000)]
    assert got(collocations(spark.createDataFrame(rows, "lang string, text string"))) == expected(rows, 30)


def test_no_rows(no_docs):
    assert collocations(no_docs).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000
    phrases = spark.createDataFrame([([1, 2], a)], "codes array<long>, a long")
    words = spark.createDataFrame([("en", "x", a + 1, 1), ("en", "y", a + 2, 2)], "lang string, word string, n long, code long")
    assert mod.scored(phrases, words).first().score == 2_000_000 * a // (2 * a + 3)
