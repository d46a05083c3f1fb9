"""Validity intervals, counts kept up by day, and counts taken while a batch is written."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from jobmart.operators import checks
from jobmart.operators.daily_counts import add_rows, day_parts, distinct_counts, replace_day_rows
from jobmart.operators.intervals import change_intervals, intervals_after, since
from jobmart.session import work_dir
from jobmart.sources import tables

SCHEMA = "k int, v int, w string, at timestamp_ntz"


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def folded(rows):
    """Brute force: the intervals of each key, one sighting after another."""
    out = []
    for k in {r[0] for r in rows if r[0] is not None}:
        own = {}
        for _, v, w, t in sorted((r for r in rows if r[0] == k and r[3] is not None), key=lambda r: (r[3], r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")):
            own.setdefault(t, (v, w))
        runs = []
        for t, values in own.items():
            if runs and runs[-1][0] == values:
                runs[-1][2] = t
            else:
                runs.append([values, t, t])
        for i, (values, start, last) in enumerate(runs):
            out.append((k, *values, start, runs[i + 1][1] if i + 1 < len(runs) else None, last))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("k", "v", "w", "valid_from", "valid_to", "last_seen").collect()), key=str)


def sightings(n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([0, 0, 0, 1, 2, 3, None]), rng.choice([None, 1, 1, 2]), rng.choice([None, "", "a", "a"]),
         at(rng.randrange(300)) if rng.random() < 0.97 else None)
        for _ in range(n)]
    return rows + rows[:20]


def test_intervals_equal_brute_force(spark):
    rows = sightings(900, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(change_intervals(df, ["k"], ["v", "w"], "at")) == folded(rows)
    assert change_intervals(df.limit(0), ["k"], ["v", "w"], "at").count() == 0


def test_intervals_in_batches(spark):
    rows = sightings(700, 8)
    batches = [[r for r in rows if r[3] and lo <= r[3] < hi] for lo, hi in [(at(0), at(90)), (at(90), at(91)), (at(91), at(301))]]
    intervals = change_intervals(spark.createDataFrame(batches[0], SCHEMA), ["k"], ["v", "w"], "at")
    for batch in [*batches[1:], batches[2], []]:  # the last one twice, and none
        intervals = intervals_after(intervals, spark.createDataFrame(batch, SCHEMA), ["k"], ["v", "w"], "at")
    assert collected(intervals) == folded(rows)


def test_intervals_after_retention_have_no_gap(spark):
    rows = [(1, 1, "a", at(0)), (1, 1, "a", at(5)), (1, 2, "a", at(9)), (1, 1, "a", at(20)), (2, 7, None, at(1))]
    kept = since(change_intervals(spark.createDataFrame(rows, SCHEMA), ["k"], ["v", "w"], "at"), at(10))
    assert collected(kept) == sorted([
        (1, 2, "a", at(10), at(20), at(9)), (1, 1, "a", at(20), None, at(20)), (2, 7, None, at(10), None, at(1))], key=str)


def test_a_hot_key_is_folded_by_day_first(spark):
    rows = spark.range(200000).select(
        F.lit(7).alias("k"), (F.col("id") / 50000).cast("int").alias("v"), F.lit("a").alias("w"),
        (F.lit(at(0)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 3)).cast("timestamp_ntz").alias("at"))
    found = collected(change_intervals(rows, ["k"], ["v", "w"], "at"))
    assert [(r[1], r[4] is None) for r in sorted(found, key=lambda r: r[3])] == [(0, False), (1, False), (2, False), (3, True)]


def counted(df, *by):
    return {tuple(r[:-1]): r[-1] for r in distinct_counts(df, list(by)).collect()}


def test_counts_by_day(spark):
    rng = random.Random(4)
    days = [date(2024, 1, d) for d in range(1, 8)]
    ids = [-40000, -1, 0, 1, 32768, 32769, 5_000_000_000, None]
    rows = [(rng.choice([*days, None]), rng.choice(["a", "b", None]), rng.choice(ids)) for _ in range(400)]
    schema = "day date, tool string, id long"

    def want(some):
        out = {}
        for d, t, i in some:
            if d and i is not None:
                out.setdefault((t,), set()).add(i)
        return {k: len(v) for k, v in out.items()}

    name = f"parts_{rng.randrange(10**9)}"
    halves = [r for r in rows if not r[0] or r[0] <= days[3]][::2], rows

    def add(some):
        frame = spark.createDataFrame(some, schema)
        return add_rows(frame, name, work_dir(spark, "parts"), "day", ["tool"], "id")

    assert counted(add(halves[0]), "tool") == want(halves[0])
    assert counted(add(halves[1]), "tool") == want(rows)
    assert counted(add(rows[:50]), "tool") == want(rows)  # known already
    assert counted(add([]), "tool") == want(rows)

    tables.expire_days(spark, name, datetime(2024, 2, 3), day="day")  # days before the 3rd go
    kept = [r for r in rows if r[0] and r[0] >= days[2]]
    assert counted(spark.table(name), "tool") == want(kept)

    changed = [(days[4], "b", 1), (days[4], "c", 2)]
    replace_day_rows(spark.createDataFrame(changed, schema), name, work_dir(spark, "parts"), "day", ["tool"], "id", [days[4]])
    assert counted(spark.table(name), "tool") == want([r for r in kept if r[0] != days[4]] + changed)


def test_only_changed_days_are_read(spark):
    rows = spark.range(1000).select(
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 9).cast("int")).alias("day"), F.lit("a").alias("tool"), "id")
    name = f"parts_{random.randrange(10**9)}"
    table = add_rows(rows, name, work_dir(spark, "parts"), "day", ["tool"], "id")
    before = tables.partition_locations(spark, name)
    add_rows(rows.filter("id = 4").withColumn("id", F.lit(70000).cast("long")), name, work_dir(spark, "parts"), "day", ["tool"], "id")
    after = tables.partition_locations(spark, name)
    assert [d for d in before if before[d] != after[d]] == ["day=2024-01-05"]
    plan = table.filter(F.col("day").isin([date(2024, 1, 5)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert counted(spark.table(name), "tool") == {("a",): 1001}
    assert day_parts(rows.limit(0), "day", ["tool"], "id").count() == 0


def test_observed_counts_come_with_the_write(spark, tmp_path):
    rows = [(1, "a"), (None, "b"), (3, None), (None, None)]
    df = spark.createDataFrame(rows, "id long, name string")
    watched, seen = checks.observed(df, ["id", "name"], {"late": F.col("id") > 2})
    watched.write.parquet(str(tmp_path / "landed"))
    assert checks.counts_of(spark, seen).sort("check").collect() == [("late", 1), ("null id", 2), ("null name", 2), ("rows", 4)]
    none, seen = checks.observed(df.limit(0), ["id"])
    none.write.parquet(str(tmp_path / "none"))
    assert checks.counts_of(spark, seen).sort("check").collect() == [("null id", 0), ("rows", 0)]
