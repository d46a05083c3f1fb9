"""Upserts into bucketed tables: the same rows as a plain upsert, without an exchange of the target."""

import random

import pytest
from pyspark.sql import functions as F

from jobmart.operators import merge
from jobmart.session import work_dir
from jobmart.sources import buckets

SCHEMA = "k long, v string"


def bucketed(spark, rows):
    name = f"bucketed_{random.randrange(10**9)}"
    buckets.write_bucketed(spark.createDataFrame(rows, SCHEMA), name, work_dir(spark, "bucketed"), ["k"], 4)
    return name


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("batch", [
    [(1, "new"), (7, "new"), (8, "x"), (8, "y"), (None, "n"), (2, None)],
    [],
])
def test_same_rows_as_upsert(spark, batch):
    target = [(i, f"old {i}") for i in range(1, 6)] + [(None, "none"), (3, "twice")]
    name = bucketed(spark, target)
    source = spark.createDataFrame([(v, k) for k, v in batch], "V string, K long")
    want = content(merge.upsert(spark.createDataFrame(target, SCHEMA), source, ["k"]))
    for _ in range(2 if all(k in range(1, 8) for k, _ in batch) else 1):
        new = f"{name}_{random.randrange(10**6)}"
        assert content(buckets.upsert_bucketed(name, source, new, work_dir(spark, "bucketed"), ["k"], 4)) == want
        name = new


def test_empty_target(spark):
    name = bucketed(spark, [])
    source = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    assert content(buckets.upserted(spark.table(name), source, ["k"], 4)) == [(1, "a"), (1, "b")]


def test_two_matching_rows_fail(spark):
    name = bucketed(spark, [(1, "a")])
    source = spark.createDataFrame([(1, "b"), (1, "c")], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        buckets.upserted(spark.table(name), source, ["k"], 4).collect()


def test_the_target_is_not_exchanged(spark):
    name = bucketed(spark, [(i, str(i)) for i in range(200)])
    source = spark.range(50, 60).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = buckets.upserted(spark.table(name), source, ["k"], 4)
        first.collect()
        plan = first._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in final

        # The next version is bucketed too, a file for each bucket, so the next upsert is as cheap.
        new = f"{name}_next"
        path = work_dir(spark, "bucketed")
        buckets.upsert_bucketed(name, source, new, path, ["k"], 4)
        assert len(spark.table(new).inputFiles()) == 4
        again = buckets.upserted(spark.table(new), source, ["k"], 4)
        assert again.filter("v = 'new'").count() == 10 and again.count() == 200
        plan = again._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
