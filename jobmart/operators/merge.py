"""Keyed merges as joins. Each returns the new table; the caller writes it once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.operators.lookup import with_key, without_key


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in target order, matched by name whatever the case; a missing one is an error."""
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    return df.select(*(F.col(f"`{have[c.lower()]}`").alias(c) for c in columns))


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Replace matched rows, add the others.

    The target meets only the source's keys, so a small batch is broadcast by size and the target is
    not shuffled. A source key that occurs twice and matches fails the job, as a merge would; NULL
    keys match nothing. The source is read twice, for its keys and its rows: land it first if it is
    costly to compute.
    """
    rows = align(source, target.columns)
    keys = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_hits"))
    twice = F.raise_error(F.lit(f"several source rows match one target row on {key}"))
    kept = target.join(keys, key, "left").filter(
        F.when(F.col("_hits") > 1, twice).otherwise(F.col("_hits").isNull())
    )
    return kept.select(*target.columns).unionByName(rows)


def insert_only(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Add the source rows whose key is new; a key enters with all its rows or not at all."""
    rows = align(source, target.columns)
    return target.unionByName(without_key(rows, target, key))


def not_yet_in(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df``, which has one row per key, whose key is not in ``done``: the work that is left."""
    return df.join(done.select(*key).distinct(), key, "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Keys of ``child`` that have no parent. Keys are reduced before they meet."""
    return not_yet_in(child.select(*key).distinct(), parent, key)


def prune_orphans(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``child`` whose parent lives."""
    return with_key(child, parent, key)


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """SQL ``NOT IN`` with its NULL rules: a NULL in the list leaves nothing, an empty list everything.

    Spark runs the SQL form by broadcasting the list. Here one pass over the list answers whether it
    is empty or holds a NULL, and an ordinary anti join, which can shuffle, does the rest.
    """
    values = listed.select(F.col(listed_column).alias("_value"))
    facts = values.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("_value").isNull()).alias("nulls")
        ).alias("facts")
    )
    listed_values = values.filter(F.col("_value").isNotNull()).withColumnRenamed("_value", column)
    left = without_key(df, listed_values, [column])
    fact = facts.scalar()
    return left.filter(
        (fact["n"] == 0) | ((fact["nulls"] == 0) & F.col(column).isNotNull())
    )
