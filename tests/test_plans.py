"""Physical plans: what must reach the scan, and what must not be in the plan."""

from datetime import datetime

import pytest

from jobmart.catalog import QUERIES
from jobmart.catalog.fixtures import table
from jobmart.operators import timerange

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def query_plan(spark, key):
    return plan(QUERIES[key](spark, SF_DIR))


def test_hour_range_is_pushed_down(spark):
    text = plan(timerange.in_hour(table(spark, SF_DIR, "events"), "ts", datetime(2024, 1, 30, 23, 30)))
    assert "GreaterThanOrEqual(ts,2024-01-30T23:00" in text
    assert "LessThan(ts,2024-01-31T00:00" in text


def test_retention_bound_is_pushed_down(spark):
    text = plan(timerange.retain(table(spark, SF_DIR, "events"), "ts", datetime(2024, 2, 10)))
    assert "Or(IsNull(ts),GreaterThan(ts,2024-01-10T00:00" in text


def test_dedup_limits_every_key_before_the_shuffle(spark):
    text = query_plan(spark, "jobs_dedup_first").split("\n\n")[0]
    first_limit = text.rindex("WindowGroupLimit")
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < first_limit  # printed top down: the last one is below the shuffle


@pytest.mark.parametrize("key", ["enrich_backlog", "orphan_ids"])
def test_anti_joins_can_shuffle(spark, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = query_plan(spark, key)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    assert "Broadcast" not in text


def test_not_in_does_not_broadcast_its_list(spark):
    # Spark's null-aware anti join would broadcast it whatever the threshold.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = query_plan(spark, "not_in_null_aware")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftAnti" in text
    assert "Broadcast" not in text


def test_small_batch_does_not_shuffle_the_target(spark):
    text = query_plan(spark, "followers_batch_upsert").split("\n\n")[0]
    assert "BroadcastHashJoin LeftOuter" in text


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<doc_id:bigint>" in query_plan(spark, "orphan_prune")
    text = query_plan(spark, "jobs_by_city")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


# Row-level Python only where the operator is a call to foreign code.
@pytest.mark.parametrize("key", sorted(set(QUERIES) - {"enrich_map_partitions"}))
def test_no_cross_join_and_no_python_in_the_plan(spark, key):
    if key.startswith(("hourly_flow", "stream_", "monthly_flow")) or key == "enrich_dead_letter":
        pytest.skip("runs its work while it is built")
    text = query_plan(spark, key)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert unwanted not in text
