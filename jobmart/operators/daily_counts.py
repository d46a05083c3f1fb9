"""Exact distinct counts kept up by day.

A day's part holds, for each group, the ids as bitmaps (32,768 ids each, as wide as Spark's bitmap functions
make them). Parts of several days merge by OR, so a day that changes or expires is replaced or dropped
without a look at the others, and an id that occurs on many days still counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.sources import tables


def day_parts(df: DataFrame, day: str, by: list[str], id_column: str) -> DataFrame:
    """(day, group, bucket, ids): the ids of each day and group. Rows without id or day are left out; NULL is a group."""
    known = df.dropna(subset=[day, id_column])
    return known.groupBy(*by, F.bitmap_bucket_number(id_column).alias("bucket"), day).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_column)).alias("ids")
    ).select(*by, "bucket", "ids", day)


def merged(parts: DataFrame, day: str, by: list[str]) -> DataFrame:
    """One part for each day, group and bucket."""
    return parts.groupBy(*by, "bucket", day).agg(F.bitmap_or_agg("ids").alias("ids")).select(*by, "bucket", "ids", day)


def distinct_counts(parts: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    """Distinct ids per group over all days of ``parts``."""
    whole = parts.groupBy(*by, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return whole.groupBy(*by).agg(F.sum(F.bitmap_count("ids")).alias(name))


def add_rows(rows: DataFrame, name: str, path: str, day: str, by: list[str], id_column: str) -> DataFrame:
    """Add rows to the table of parts ``name``, which is made if it is missing; returns the table.

    Only the days that occur in ``rows`` are read and rewritten, under ``path``; the list of these days is all
    that comes to the driver. Rows that are added twice change nothing.
    """
    spark = rows.sparkSession
    new = tables.land(day_parts(rows, day, by, id_column), f"{path}-new")
    if not spark.catalog.tableExists(name):
        return tables.write_by_day(new, name, path, day, day)
    days = [r[0] for r in new.select(day).distinct().orderBy(day).toLocalIterator()]
    if not days:
        return spark.table(name)
    old = spark.table(name).filter(F.col(day).isin(days))
    return tables.replace_days(merged(old.unionByName(new), day, by), name, path, day, days)


def replace_day_rows(rows: DataFrame, name: str, path: str, day: str, by: list[str], id_column: str, days: list) -> DataFrame:
    """Replace the parts of ``days`` by those of ``rows``, which are all rows of these days; other days are not read."""
    return tables.replace_days(day_parts(rows.filter(F.col(day).isin(days)), day, by, id_column), name, path, day, days)
