"""Constraints that Parquet does not enforce, checked inside the plan."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows with a NULL in a required column, and which columns those are."""
    names = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required)))
    return df.withColumn("violated", F.array_join(names, ",")).filter(F.col("violated") != "")


def require_not_null(df: DataFrame, required: list[str]) -> DataFrame:
    """The same rows; a NULL in a required column fails the job that reads it."""
    checked = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in required column {c}")))
        .otherwise(F.col(c))
        for c in required
    }
    return df.withColumns(checked)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def observed(df: DataFrame, required: list[str], rules: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they are written: all, NULLs per required column, rows that meet each rule.

    The counts belong to the first action on the returned rows, so write these rows and read them with
    ``counts_of`` afterwards: no second scan.
    """
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    counts = {f"null {c}": F.col(c).isNull() for c in required} | (rules or {})
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in counts.items())), seen


def counts_of(spark: SparkSession, seen: Observation) -> DataFrame:
    """(check, n) of an observed write, a row for each check."""
    return spark.createDataFrame(sorted(seen.get.items()), "check string, n long")
