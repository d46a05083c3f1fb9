"""Joins that look rows up by key.

Both sides go into the join as they are: neither is aggregated first, so that each is a plain exchange
and Spark's adaptive skew join can split a key that owns much of the left side. Which keys are heavy is
measured by Spark on the shuffled data; nothing is estimated here, and no key is treated apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_key(df: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, which may hold a key several times."""
    return df.join(keys.select(*key), key, "left_semi")


def without_key(df: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``; a NULL key is in nothing."""
    return df.join(keys.select(*key), key, "left_anti")
