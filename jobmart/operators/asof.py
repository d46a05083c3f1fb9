"""As-of join: for each row the last value known at its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    rows: DataFrame, history: DataFrame, key: str, time: str, history_key: str, history_time: str, value: str, unit: str = "day"
) -> DataFrame:
    """``rows`` with ``value``: that of the last history row of its key at or before its time, NULL if there is none.

    Both sides are put in one order and the last value is carried on, so no pairs are made. A key's rows are cut
    into ranges of ``unit``, which are windows of their own; the value at the end of each range is carried
    over to the later ones in a second window, which has one row a range. So a key that holds a third of all
    rows is as many groups as it has ranges. Of several history rows at one time the largest value counts; NULL
    values are no history; rows without key or time get NULL.
    """
    known = history.select(F.col(history_key).alias("_key"), F.col(history_time).alias("_time"), F.col(value).alias("_value")) \
        .filter("_key IS NOT NULL AND _time IS NOT NULL AND _value IS NOT NULL") \
        .groupBy("_key", "_time").agg(F.max("_value").alias("_value")).withColumn("_range", F.date_trunc(unit, F.col("_time")))
    own = F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row")
    asked = rows.select(F.col(key).alias("_key"), F.col(time).alias("_time"), own).withColumn("_range", F.date_trunc(unit, F.col("_time")))
    placed = asked.filter("_key IS NOT NULL AND _time IS NOT NULL")
    both = placed.unionByName(known, allowMissingColumns=True)
    # At equal times history goes first, as it counts from its time on.
    order = Window.partitionBy("_key", "_range").orderBy("_time", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_last", F.last("_value", ignorenulls=True).over(order)).filter(F.col("_row").isNotNull())
    ends = both.groupBy("_key", "_range").agg(F.max(F.when(F.col("_value").isNotNull(), F.struct("_time", "_value"))).alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_key", "_range", F.last("_end", ignorenulls=True).over(earlier)["_value"].alias("_before"))
    found = within.join(carried, ["_key", "_range"]).select("_row", F.coalesce("_last", "_before").alias("_value"))
    rest = asked.filter("_key IS NULL OR _time IS NULL").select("_row", F.lit(None).cast(history.schema[value].dataType).alias("_value"))
    return found.unionByName(rest).select("_row.*", F.col("_value").alias(value))
