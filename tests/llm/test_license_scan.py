import random
import re

import pytest

from jobmart.llm.license_scan import NAMES, TEXTS, licenses
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for name, label in NAMES.items():
        own = name.split()
        for i in range(len(words) - len(own) + 1):
            if words[i:i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    parts = [*NAMES, "MIT", "license", "Cc", "by", "CC-BY", "cc by cc by", "GNU General Public Licensé", "mit-license", "K", "İ", "gpl",
             "é", "1", "...", "\n", "apache", "public", "general"]
    return [" ".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(300)] + [None, "", "...", prose(3, 20_000) + " MIT License."]


def test_names_same_as_brute_force(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_texts_with_edits(spark):
    rows, want = [], {}
    for k, (label, text) in enumerate(TEXTS):
        words = text.split()
        words[len(words) // 3] = "changed"
        words.insert(2 * len(words) // 3, "inserted")
        rows.append((k, prose(k, 100) + " " + " ".join(words).upper() + " " + prose(k + 50, 100)))
        want[k] = label
    rows.append((99, prose(99, 300) + " permission is hereby granted"))
    got = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, label in want.items():
        if len(TEXTS[k][1].split()) >= 20:  # two edits destroy most grams of a shorter one
            assert label in got[k].labels.split(",") and 0.4 < got[k].score <= 1, TEXTS[k]
    assert got[99].labels == "" and 0 < got[99].score < 0.5


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs):
        got = licenses(docs).collect()
        assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(r.doc_id), base(r.text)[0]) for r in docs.collect())
        assert all(r.labels == "" and r.score == 0 for r in got)
    assert licenses(no_docs).count() == 0
    twice = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (1, "cc by"), (None, "cc by")], "doc_id long, text string")
    assert sorted((r.n_base, r.labels) for r in licenses(twice).collect()) == [(1, "cc-by"), (1, "cc-by"), (1, "mit"), (1, "mit")]


def test_no_python_in_the_plan(spark, odd_docs):
    plan = licenses(odd_docs.select("doc_id", "text").union(spark.range(1).selectExpr("id", "'x'"))) \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
