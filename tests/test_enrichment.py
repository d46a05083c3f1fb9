"""Model answers, flattening, retries and lexicon matching."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobmart.operators import enrichment
from jobmart.plans import jobs_flow
from jobmart.schemas import ENRICH_FAILURES, ENRICHED, ENRICHED_LISTS
from jobmart.sources import readers


def answers(spark, *responses):
    df = spark.createDataFrame(list(enumerate(responses)), "JobId BIGINT, response STRING")
    return enrichment.parse_answers(df)


def test_answers_that_break_the_contract(spark):
    got = answers(
        spark,
        '{"Tools":["a"],"Requirements":[],"Offer":null,"WorkType":"Remote","Extra":1}',
        '{"Tools":"solo","Requirements":7}',
        "not json",
        '["a"]',
        None,
        '{"Tools":["cut',
        ' {"Tools":["[x]"],"Offer":"[y"}',
    ).orderBy("JobId").collect()
    assert [tuple(r)[1:] for r in got] == [
        (["a"], [], None, "Remote", "ok"),
        (["solo"], ["7"], None, None, "ok"),
        (None, None, None, None, "bad_json"),
        (None, None, None, None, "bad_json"),
        (None, None, None, None, "bad_json"),
        (None, None, None, None, "bad_json"),
        (["[x]"], None, ["[y"], None, "ok"),
    ]


def test_wide_and_long(spark):
    parsed = answers(
        spark, '{"Tools":["a","b"],"Requirements":["r"],"Offer":[]}', "not json",
        '{"Tools":["a","a"],"Requirements":["r","s"],"Offer":["o"]}',
    )
    wide = enrichment.explode_wide(parsed)
    counts = {r.JobId: r["count"] for r in wide.groupBy("JobId").count().collect()}
    assert counts == {0: 2, 1: 1, 2: 4}
    long = enrichment.explode_long(parsed)
    assert long.filter("JobId = 0").count() == 3
    assert long.filter("JobId = 1").count() == 0
    for kind in enrichment.LISTS:
        from_wide = wide.filter(F.col(kind).isNotNull()).select("JobId", F.col(kind).alias("value")).distinct()
        from_long = long.filter(F.col("kind") == kind).select("JobId", "value")
        assert sorted(from_wide.collect()) == sorted(from_long.collect())


def test_failed_answers_stay_backlog(spark):
    jobs = spark.createDataFrame([(0, "x"), (1, "y")], "JobId BIGINT, JobDescription STRING")
    got = spark.createDataFrame([(0, '{"Tools":["a"]}'), (1, "not json")], "JobId BIGINT, response STRING")
    enriched = jobs_flow.enriched_after(readers.empty_table(spark, ENRICHED), got, jobs, wide=True)
    assert [tuple(r) for r in enriched.collect()] == [(0, "a", None, None, "In-Office")]
    assert [r.JobId for r in jobs_flow.backlog(jobs, enriched).collect()] == [1]


def test_list_and_wide_tables_say_the_same(spark):
    jobs = spark.createDataFrame([(i, "x") for i in range(4)], "JobId BIGINT, JobDescription STRING")
    got = spark.createDataFrame(
        [(0, '{"Tools":["a","b"],"Offer":["o"]}'), (1, "{}"), (2, "x"), (9, '{"Tools":["gone"]}')],
        "JobId BIGINT, response STRING",
    )
    lists = jobs_flow.enriched_after(readers.empty_table(spark, ENRICHED_LISTS), got, jobs)
    wide = jobs_flow.enriched_after(readers.empty_table(spark, ENRICHED), got, jobs, wide=True)
    assert lists.count() == 2
    assert sorted(enrichment.explode_wide(lists).collect()) == sorted(wide.collect())


def test_retries(spark):
    jobs = spark.createDataFrame(
        [(0, "fine"), (1, "busy"), (2, "always busy"), (3, "broken")], "JobId BIGINT, JobDescription STRING"
    )

    def client():
        asked = []

        def ask(text):
            asked.append(text)
            if text == "always busy" or (text == "busy" and asked.count(text) < 3):
                raise RuntimeError("429 Too Many Requests, retry after 3 seconds")
            if text == "broken":
                raise ValueError("no")
            return "{}"

        return ask

    called = enrichment.call_model(
        jobs.coalesce(1), client(), max_tries=5, sleep=lambda seconds: None, partitions=2
    )
    got = {r.JobId: (r.response, r.status, r.attempts) for r in called.collect()}
    assert got == {
        0: ("{}", "ok", 1), 1: ("{}", "ok", 3), 2: (None, "failed", 5), 3: (None, "failed", 1),
    }
    assert sorted(r.JobId for r in enrichment.dead_letters(called).collect()) == [2, 3]


def test_lexicon_forms_agree(spark):
    lexicon = {"Tools": ["spark", "sql"], "Requirements": ["sql"], "Offer": [], "Remote": ["home"]}
    jobs = spark.createDataFrame(
        [(0, "Spark, SQL (and more) from home."), (1, "sparkling"), (2, None), (3, "w " * 20000 + "spark")],
        "JobId BIGINT, JobDescription STRING",
    )
    found = {r.JobId: r for r in enrichment.match_lexicon(jobs, lexicon).collect()}
    assert sorted(found[0].Tools) == ["spark", "sql"]
    assert (found[0].Requirements, found[0].Offer, found[0].WorkType) == (["sql"], [], "Remote")
    assert (found[1].Tools, found[1].WorkType, found[3].Tools) == ([], None, ["spark"])
    table = spark.createDataFrame(
        [(k, w) for k, listed in lexicon.items() for w in listed], "kind STRING, token STRING"
    )
    long = enrichment.match_lexicon_table(jobs, table)
    assert sorted(tuple(r) for r in long.filter("kind = 'Tools'").collect()) == [
        (0, "Tools", "spark"), (0, "Tools", "sql"), (3, "Tools", "spark")
    ]


@pytest.mark.parametrize("answer, status", [
    ('\n {"Tools":["a"]}\n', "ok"), ('{"Tools":["a"]} trailing words', "bad_json"), ('{"Tools":["a"]} {"Tools":["b"]}', "bad_json"),
    ('["a"]', "bad_json"), ("", "bad_json"), (None, "bad_json"), ("{}", "ok"), ('{"Tools":["}]"]}', "ok"), ('{"Tools":["a"]', "bad_json"),
])
def test_only_an_object_is_an_answer(spark, answer, status):
    df = spark.createDataFrame([(1, answer)], "JobId BIGINT, response STRING")
    assert enrichment.parse_answers(df).first().status == status


def test_calls_are_spread(spark):
    jobs = spark.range(2000, numPartitions=1).selectExpr("id AS JobId", "'x' AS JobDescription")
    called = enrichment.call_model(jobs, lambda text: "{}", partitions=8)
    tasks = called.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) == 8 and sum(r["count"] for r in tasks) == 2000
    assert enrichment.call_model(jobs, lambda text: "{}").rdd.getNumPartitions() == 4


def test_equal_texts_are_asked_once(spark):
    jobs = spark.createDataFrame(
        [(k, "shared" if k % 3 else None if k % 2 else f"own {k}") for k in range(60)], "JobId BIGINT, JobDescription STRING")
    made = spark.sparkContext.accumulator(0)

    def ask(text):
        made.add(1)
        if text is None:
            raise ValueError("no text")
        return text

    called = enrichment.call_model_once(jobs, ask, partitions=3)
    got = {r.JobId: (r.response, r.status) for r in called.collect()}
    assert made.value == 12  # 10 of their own, the shared one, the missing one
    assert got == {
        k: ("shared", "ok") if k % 3 else (None, "failed") if k % 2 else (f"own {k}", "ok") for k in range(60)}
    assert enrichment.call_model_once(jobs.limit(0), ask).count() == 0


def test_stand_in_tells_each_call_once():
    from concurrent.futures import ThreadPoolExecutor

    from jobmart.catalog.enrich import stand_in_model

    ask = stand_in_model()

    def attempts(text):
        try:
            ask(text)
            return 1
        except RuntimeError:
            ask(text)
            return 2

    with ThreadPoolExecutor(8) as pool:
        assert set(pool.map(attempts, ["12345"] * 4000)) == {2}


def test_failures_wait_longer_each_time(spark):
    at = [datetime(2024, 1, 1, h) for h in range(12)]
    jobs = spark.createDataFrame([(1, "x")], "JobId BIGINT, JobDescription STRING")
    failures = spark.createDataFrame([], ENRICH_FAILURES)
    asked = []
    for now in at:
        if enrichment.not_given_up(jobs, failures, now).count():
            asked.append(now.hour)
            failed = spark.createDataFrame([(1, None, "failed", "down")], "JobId BIGINT, response STRING, status STRING, error STRING")
            failures = spark.createDataFrame(enrichment.failures_after(failures, failed, now).collect(), ENRICH_FAILURES)
    assert asked == [0, 1, 3, 7]


def test_unknown_keys(spark):
    answers = ['{"Tools":["a"],"extra":1,"Extra":[2]}', '{"extra":1.5,"o":{"x":1},"n":null,"b":true,"s":"t"}', "[1, 2]", "7", "", None, "no json", '{"extra":"s"}']
    df = spark.createDataFrame([(k, a) for k, a in enumerate(answers)], "JobId BIGINT, response STRING")
    assert sorted(map(tuple, enrichment.unknown_keys(df).collect())) == [
        ("Extra", "array", 1), ("b", "boolean", 1), ("extra", "number", 2), ("extra", "string", 1), ("n", "null", 1), ("o", "object", 1),
        ("s", "string", 1)]
    assert enrichment.unknown_keys(df.limit(0)).count() == 0


def test_phrases(spark):
    phrases = spark.createDataFrame(
        [("Tools", "Power BI"), ("Tools", "power"), ("Tools", "azure data factory"), ("Offer", "data factory"), ("Offer", "factory job"),
         ("Offer", "Power BI"), ("Tools", ""), ("Tools", None)], "kind STRING, phrase STRING")
    jobs = spark.createDataFrame(
        [(0, "We use Power BI, Azure Data Factory job"), (1, "data factory job"), (2, "power power bi power"), (3, None), (4, "azure data"),
         (5, "power " * 3000)], "JobId BIGINT, JobDescription STRING")
    got = enrichment.match_phrases(jobs, phrases)
    assert sorted(tuple(r) for r in got.filter("JobId < 5").collect()) == [
        (0, 2, 2, "power bi", "Offer"), (0, 2, 2, "power bi", "Tools"), (0, 4, 3, "azure data factory", "Tools"), (1, 0, 2, "data factory", "Offer"),
        (2, 0, 1, "power", "Tools"), (2, 1, 2, "power bi", "Offer"), (2, 1, 2, "power bi", "Tools"), (2, 3, 1, "power", "Tools")]
    assert got.filter("JobId = 5").count() == 3000
    assert enrichment.match_phrases(jobs, phrases.limit(0)).count() == enrichment.match_phrases(jobs.limit(0), phrases).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_task_holds_few_descriptions_at_once(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        todo = spark.range(1000).selectExpr("id AS JobId", "concat('text ', id) AS JobDescription")
        answers = enrichment.call_model(todo, lambda text: text, partitions=1)
        sizes = answers.mapInPandas(lambda batches: (b.assign(n=len(b))[["n"]] for b in batches), "n int").distinct().collect()
        assert max(r.n for r in sizes) <= enrichment.CALLED_ROWS
        assert answers.filter("response = concat('text ', JobId) AND status = 'ok'").count() == 1000
    finally:
        spark.conf.set(key, before)
