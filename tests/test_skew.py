"""Lookups under heavy keys: same rows as plain joins in SQL, heavy keys split by Spark."""

import pytest
from pyspark.sql import functions as F

from jobmart.operators import enrichment, lookup


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def left_side(spark, heavy):
    """``heavy`` keys share two thirds of the rows evenly, others and NULL the rest."""
    shared = F.col("id") % 3 < 2
    k = F.when(shared, F.col("id") % heavy).when(F.col("id") % 5 == 0, None).otherwise(1000 + F.col("id") % 500)
    return spark.range(0, 30_000, 1, 6).select(k.alias("k"), (F.col("id") % 11).alias("v"))


@pytest.mark.parametrize("heavy", [1, 150])  # one key with most rows, and 150 that tie
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_same_as_sql(spark, heavy, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = left_side(spark, heavy)
        keys = spark.range(0, 1300, 2).select(F.col("id").alias("k")).unionByName(spark.sql("SELECT 4L AS k"))
        left.createOrReplaceTempView("skew_left")
        keys.createOrReplaceTempView("skew_keys")
        assert rows(lookup.with_key(left, keys, ["k"])) == rows(
            spark.sql("SELECT * FROM skew_left l WHERE EXISTS (SELECT 1 FROM skew_keys s WHERE s.k = l.k)"))
        assert rows(lookup.without_key(left, keys, ["k"])) == rows(
            spark.sql("SELECT * FROM skew_left l WHERE NOT EXISTS (SELECT 1 FROM skew_keys s WHERE s.k = l.k)"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_sides(spark):
    left, keys = left_side(spark, 1), spark.range(10).select(F.col("id").alias("k"))
    assert lookup.with_key(left.limit(0), keys, ["k"]).count() == 0
    assert lookup.with_key(left, keys.limit(0), ["k"]).count() == 0
    assert lookup.without_key(left, keys.limit(0), ["k"]).count() == left.count()


@pytest.fixture
def small_skew(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", [lookup.with_key, lookup.without_key])
def test_spark_splits_a_heavy_key(spark, small_skew, operator):
    left = left_side(spark, 1).withColumn("pad", F.sha2(F.col("v").cast("string"), 256))
    keys = spark.range(0, 1300, 2).select(F.col("id").alias("k"))
    assert "skew=true" in final_plan(operator(left, keys, ["k"]))


def test_spark_splits_a_common_word(spark, small_skew):
    text = F.concat(F.lit("the "), F.sha2(F.col("id").cast("string"), 256))
    jobs = spark.range(0, 20_000, 1, 6).select(F.col("id").alias("JobId"), text.alias("JobDescription"))
    words = spark.range(400).selectExpr("'Tools' AS kind", "concat('w', id) AS token") \
        .unionByName(spark.sql("SELECT 'Tools' AS kind, 'the' AS token"))
    found = enrichment.match_lexicon_table(jobs, words)
    assert "skew=true" in final_plan(found)
    assert found.count() == 20_000
