import re

import pytest

from jobmart.llm.decontaminate import leaks, template_words, without_leaks
from tests.llm.conftest import prose

ITEMS = [
    (1, "Tom has 12 apples and gives 5 apples to Anna, so how many apples does Tom keep after that day?"),
    (2, "which of these rivers flows through the largest number of capital cities in all of the world today"),
    (3, "a train leaves at 9 and runs 80 km per hour, how far does the train get in 3 hours at that speed"),
    (4, "short item of six words"),
    (5, "tiny"),
    (6, None),
    (None, "an item without an id that is long enough to be searched for"),
    (7, "1 2 3 4 5 6 7 8 9 10"),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def around(k, text):
    return f"{prose(k, 50)} {text} {prose(k + 100, 50)}"


def found(docs, benchmark):
    return {(r.doc_id, r.item_id): r for r in leaks(docs, benchmark).collect()}


def test_verbatim_and_renamed(spark, benchmark):
    docs = spark.createDataFrame([
        (10, around(1, ITEMS[0][1])),
        (11, around(2, "Ben has 30 apples and gives 8 apples to Lisa, so how many apples does Ben keep after that day?")),
        (12, around(3, "Ben has 30 apples and gives 8 apples to Lisa, so how many apples does Max keep after that day?")),
        (13, around(4, ITEMS[1][1].upper())),
        (14, around(5, "a train leaves at 7 and runs 95 miles per hour, how far does the train get in 2.5 hours at that speed")),
        (15, around(6, "which of these rivers flows north")),
        (16, around(7, "a short item of six words")),
        (17, around(8, "a short item of seven words")),
        (18, around(9, "7 2 9 4 5 6 1 8 0 10")),
        (19, prose(20, 500)),
    ], "doc_id long, text string")
    got = found(docs, benchmark)
    assert set(got) == {(10, 1), (11, 1), (13, 2), (14, 3), (16, 4)} | ({(12, 1)} & set(got))
    assert got[10, 1].verbatim and got[13, 2].verbatim and not got[11, 1].verbatim and not got[14, 3].verbatim
    assert got[11, 1].consistency == 1.0 and got[13, 2].coverage == 1.0
    assert got[13, 2].first_word == 50
    assert without_leaks(docs, benchmark).where("doc_id IN (10, 11, 13, 14, 16)").count() == 0
    assert without_leaks(docs, benchmark).where("doc_id IN (15, 17, 18, 19)").count() == 4


def test_inconsistent_slots(spark, benchmark):
    # Every second value of the item stands for two values in the document.
    item = spark.createDataFrame([(1, "first 5 then 5 then again 5 and also 5 of those 5 in the end")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "first 1 then 2 then again 3 and also 4 of those 5 in the end"),
                                  (2, "first 8 then 8 then again 8 and also 8 of those 8 in the end")], "doc_id long, text string")
    assert set(found(docs, item)) == {(2, 1)}


def test_marks(spark):
    row = spark.createDataFrame([("He met Anna, paid 3.50 EUR. Then 5kg. İx K",)], "t string").select(template_words(spark_col("t"))).first()[0]
    assert row[:9] == ["he", "met", "\x01anna", "paid", "3_50", "\x02eur", "then", "5", "\x02kg"]


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_odd_rows(spark, benchmark, odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs):
        assert leaks(docs, benchmark).count() == 0
        kept = without_leaks(docs, benchmark)
        assert kept.count() == docs.count() and kept.columns == docs.columns
    assert leaks(no_docs, benchmark).count() == 0
    assert leaks(odd_docs, benchmark.limit(0)).count() == 0
    text = around(1, ITEMS[1][1])
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (1, "other")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in leaks(docs, benchmark.unionByName(benchmark)).collect()) == ["1", "None"]
    assert [r.text for r in without_leaks(docs, benchmark).collect()] == ["other"]


def test_shuffled_benchmark_gives_the_same(spark, benchmark, monkeypatch):
    from jobmart.llm import decontaminate

    docs = spark.createDataFrame([(k, around(k, ITEMS[k % 3][1])) for k in range(30)], "doc_id long, text string")
    want = found(docs, benchmark)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert found(docs, benchmark) == want and len(want) == 30


def test_every_planted_passage(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = set(found(docs, benchmark))
    want = {(d.doc_id, b.item_id) for b in benchmark.collect() for d in docs.collect() if d.text and b.text in d.text}
    assert want <= got and len(got) <= len(want) + 3


def test_no_python_in_the_plan(spark, benchmark, odd_docs):
    plan = leaks(odd_docs, benchmark)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_changed_passages(spark):
    words = prose(400, 38).split()
    item = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(prose(401, 30).split())), (3, prose(402, 100))], "item_id long, text string")
    swapped, long = prose(401, 30).split(), prose(402, 100).split()
    swapped[10], swapped[20] = "other", "words"
    docs = spark.createDataFrame([
        (1, around(11, " ".join([*words[:19], "inserted", *words[19:]]))),
        (2, around(12, " ".join([*words[:19], *words[20:]]))),
        (3, around(13, " ".join([*words[:19], "two", "names", *words[20:]]))),
        (4, around(14, " ".join(swapped))),
        (5, around(15, " ".join(long[30:70]))),
        (6, around(16, " ".join(long[30:42]))),
    ], "doc_id long, text string")
    got = found(docs, item)
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 3)}
    assert (got[1, 1].first_word, got[1, 1].n_words) == (50, 39)


def test_dense_items_by_their_words(spark):
    item = spark.createDataFrame([
        (1, "12 + 7 = 19 and 30 - 4 = 26 and 8 * 9 = 72"), (2, "we met Anna, Bert, Carla, Dora, Emil, Frida, Gustav, Hanna, Ida and Jonas"),
        (3, "12 15 18 21 24"),
    ], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, around(21, "12 + 7 = 19 and 30 - 4 = 26 and 8 * 9 = 72")),
        (2, around(22, "we met Anna, Bert, Carla, Dora, Emil, Frida, Gustav, Hanna, Ida and Jonas")),
        (3, around(23, "12 15 18 21 24")), (4, around(24, "13 + 5 = 18 and 31 - 3 = 28 and 5 * 9 = 45")), (5, around(25, "11 14 17 20 23")),
    ], "doc_id long, text string")
    got = found(docs, item)
    assert set(got) == {(1, 1), (2, 2), (3, 3)} and all(r.verbatim and r.coverage == 1.0 for r in got.values())
