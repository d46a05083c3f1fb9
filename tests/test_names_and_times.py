"""City names that are not written alike, and values as of a time."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from jobmart.operators.asof import as_of_join
from jobmart.operators.names import MARKED, PLAIN, folded, match_names


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_folding(spark):
    assert len(MARKED) == len(PLAIN)
    names = ["Göteborg", " GÖTEBORG, kommun", "Upplands-Väsby", "Håbo  Kommun", None, "", "kommun", "!"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r[0] for r in df.select(folded(F.col("name"))).collect()] == ["goteborg", "goteborg", "upplands vasby", "habo", "", "", "kommun", ""]


def test_matches_equal_all_pairs(spark):
    rng = random.Random(6)
    known = {"".join(rng.choices("abå", k=rng.randint(1, 6))) for _ in range(120)}
    names = {"".join(rng.choices("abå", k=rng.randint(1, 7))) for _ in range(150)} | {"ABBA kommun", "x"}
    fold = lambda s: s.lower().replace("å", "a").removesuffix(" kommun")
    want = {}
    for a in names:
        near = [(distance(fold(a), fold(b)), a != b, b) for b in known]
        near = [n for n in near if n[0] == 0 or n[0] == 1 and min(len(fold(a)), len(fold(n[2]))) >= 4]
        if near:
            want[a] = (min(near)[2], min(near)[0])
    left = spark.createDataFrame([(n,) for n in [*names, None, ""]], "name string")
    right = spark.createDataFrame([(n,) for n in [*known, None, "", ""]], "known string")
    got = match_names(left, right)
    assert {r.name: (r.known, r.distance) for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Python" not in plan
    assert match_names(left.limit(0), right).count() == match_names(left, right.limit(0)).count() == 0


def test_as_of(spark):
    rng = random.Random(3)
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    # Key 0 holds most rows, over many days; some keys have no history, some rows no key or time.
    rows = [(k, rng.choice([0, 0, 0, 1, 2, 3, None]), at(rng.randrange(400)) if rng.random() < 0.95 else None) for k in range(1500)]
    history = [(rng.choice([0, 1, 2, 9, None]), at(rng.randrange(400)), rng.choice([None, *range(50)])) for _ in range(300)]
    rows += [(5000, 0, history[0][1]), (5000, 0, history[0][1])]
    want = []
    for k, key, t in rows:
        seen = [(h, v) for hk, h, v in history if None not in (key, t, v) and hk == key and h <= t]
        want.append((k, key, t, max(seen)[1] if seen else None))
    left = spark.createDataFrame(rows, "id int, key int, t timestamp_ntz").withColumn("_last", F.lit(1))
    right = spark.createDataFrame(history, "url int, h timestamp_ntz, v int")
    for unit in ("day", "month"):
        got = as_of_join(left, right, "key", "t", "url", "h", "v", unit)
        assert got.columns == ["id", "key", "t", "_last", "v"]
        assert sorted((tuple(r) for r in got.drop("_last").collect()), key=str) == sorted(want, key=str)
    assert as_of_join(left, right.limit(0), "key", "t", "url", "h", "v").filter("v IS NULL").count() == len(rows)
    assert as_of_join(left.limit(0), right, "key", "t", "url", "h", "v").count() == 0


def test_a_heavy_key_is_many_groups(spark):
    rows = spark.range(20_000).selectExpr("id", "if(id % 3 < 2, 0, id) AS key", "timestampadd(MINUTE, cast(id as int), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS t")
    history = rows.filter("id % 7 = 0").selectExpr("key AS url", "t AS h", "id AS v")
    got = as_of_join(rows, history, "key", "t", "url", "h", "v")
    assert got.filter("key = 0 AND v IS NULL").count() == 0
    assert got.filter("key = 0").filter("v > id OR id - v > 14").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 2 and "_key" in plan
