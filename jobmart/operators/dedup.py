"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: list[str], order_by: str, keep: str = "first") -> DataFrame:
    """The earliest (or latest) row of every key; equal times are settled by the other columns.

    ``rn = 1`` over ``row_number`` makes Spark cut every key down to one row per task before the
    shuffle (WindowGroupLimit), so a key that holds a third of the rows moves one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    time = F.col(order_by).asc_nulls_first() if keep == "first" else F.col(order_by).desc_nulls_last()
    ties = [F.col(c) for c in df.columns if c != order_by and c not in key]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(time, *ties)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def candidates(df: DataFrame, key: list[str], time: Column, keep: str = "first") -> DataFrame:
    """The rows of every key at its earliest (or latest) ``time``, all of them if several share it.

    ``keep_one`` of these is ``keep_one`` of all rows, so what is costly per row can wait until here. As there, a
    key is cut down within each task before the shuffle.
    """
    order = time.asc_nulls_first() if keep == "first" else time.desc_nulls_last()
    ranked = df.withColumn("_rank", F.rank().over(Window.partitionBy(*key).orderBy(order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def distinct_keys(df: DataFrame, *key: str) -> DataFrame:
    """The set of keys, partially reduced before the shuffle."""
    return df.select(*key).distinct()
