"""Time predicates written as ranges, so that they reach the Parquet scan, and retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(df: DataFrame, ts: str, when: datetime) -> Column:
    """``when`` as a literal of the type of column ``ts``: no cast on the column, so it is pushed down."""
    return F.lit(when.isoformat(sep=" ")).cast(df.schema[ts].dataType)


def in_hour(df: DataFrame, ts: str, as_of: datetime, day: str | None = None) -> DataFrame:
    """Rows of the clock hour that ``as_of`` lies in."""
    start = as_of.replace(minute=0, second=0, microsecond=0)
    return between(df, ts, start, start + timedelta(hours=1), day)


def between(
    df: DataFrame, ts: str, start: datetime, end: datetime, day: str | None = None
) -> DataFrame:
    """Rows with ``start <= ts < end``; ``day`` names the day-partition column, if there is one."""
    rows = df.filter((F.col(ts) >= instant(df, ts, start)) & (F.col(ts) < instant(df, ts, end)))
    if day:
        rows = rows.filter(F.col(day).between(F.lit(start.date()), F.lit(end.date())))
    return rows


def age_in_days(df: DataFrame, ts: str, as_of: datetime) -> Column:
    """Full 24-hour days between ``ts`` and ``as_of``; calendar boundaries do not count."""
    return F.timestamp_diff("DAY", F.col(ts), instant(df, ts, as_of))


def is_expired(df: DataFrame, ts: str, as_of: datetime, days: int = 30) -> Column:
    """More than ``days`` full days old: the same as at least ``days + 1``, hence a plain bound."""
    return F.col(ts) <= instant(df, ts, as_of - timedelta(days=days + 1))


def retain(df: DataFrame, ts: str, as_of: datetime, days: int = 30) -> DataFrame:
    """Rows that stay; a row without a time stays."""
    cutoff = instant(df, ts, as_of - timedelta(days=days + 1))
    return df.filter(F.col(ts).isNull() | (F.col(ts) > cutoff))


def expired(df: DataFrame, ts: str, as_of: datetime, days: int = 30) -> DataFrame:
    return df.filter(is_expired(df, ts, as_of, days))
