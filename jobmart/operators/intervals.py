"""Validity intervals: from when to when a row's values held, folded from its sightings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.operators import lookup


def _folded(runs: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Neighbouring runs of equal values made one; NULL equals NULL."""
    in_time = Window.partitionBy(*key).orderBy("valid_from", "last_seen")
    now = F.struct(*values)
    new = F.coalesce((~now.eqNullSafe(F.lag(now).over(in_time))).cast("int"), F.lit(1))
    numbered = runs.withColumn("_new", new).withColumn("_run", F.sum("_new").over(in_time))
    return numbered.groupBy(*key, "_run").agg(
        *(F.first(v).alias(v) for v in values),
        F.min("valid_from").alias("valid_from"), F.max("last_seen").alias("last_seen"),
    ).drop("_run")


def _day_runs(sightings: DataFrame, key: list[str], values: list[str], ts: str) -> DataFrame:
    """Runs of each key and day. Of several sightings at one time the one with the least values counts, NULL first."""
    rows = sightings.select(*key, *values, F.col(ts).alias("valid_from"), F.col(ts).alias("last_seen"))
    known = rows.dropna(subset=[*key, "valid_from"]).withColumn("_day", F.to_date("valid_from"))
    by_time = Window.partitionBy(*key, "_day").orderBy("valid_from", *values)
    before = F.lag("valid_from").over(by_time)
    single = known.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("_before") < F.col("valid_from")))
    return _folded(single.drop("_before"), [*key, "_day"], values).drop("_day")


def _closed(runs: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """A run ends where the next one begins, so nothing lies between them; the last one is open (NULL)."""
    after = F.lead("valid_from").over(Window.partitionBy(*key).orderBy("valid_from", "last_seen"))
    return runs.withColumn("valid_to", after).select(*key, *values, "valid_from", "valid_to", "last_seen")


def change_intervals(sightings: DataFrame, key: list[str], values: list[str], ts: str) -> DataFrame:
    """One row for each stretch of time in which a key's ``values`` stayed the same.

    Returns key, values, ``valid_from`` (first sighting), ``valid_to`` (first sighting of other values, NULL
    while they hold) and ``last_seen``. Rows without key or time are left out. Each day of a key is folded by
    itself first, so a key that is seen very often reaches the second window with its changes only.
    """
    return _closed(_folded(_day_runs(sightings, key, values, ts), key, values), key, values)


def intervals_after(intervals: DataFrame, batch: DataFrame, key: list[str], values: list[str], ts: str) -> DataFrame:
    """Intervals with the sightings of a later batch folded in; intervals of keys outside the batch stay as they are.

    A batch that is folded in twice changes nothing. A sighting that is late, within a stored interval,
    begins its own there; the stored interval's later sightings are known by their last time only.
    """
    seen = _day_runs(batch, key, values, ts)
    keys = batch.select(*key).dropna().distinct()
    runs = lookup.with_key(intervals, keys, key).drop("valid_to").unionByName(seen)
    return lookup.without_key(intervals, keys, key).unionByName(_closed(_folded(runs, key, values), key, values))


def since(intervals: DataFrame, when: datetime) -> DataFrame:
    """What held after ``when``: intervals that ended by then go, one that reaches across begins there."""
    bound = F.lit(when).cast(intervals.schema["valid_from"].dataType)
    return intervals.filter(F.col("valid_to").isNull() | (F.col("valid_to") > bound)) \
        .withColumn("valid_from", F.greatest("valid_from", bound))
