"""Scalar cleaning of scraped job fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The scraper's marker for a missing company, and the work types a job may have.
MISSING = "N/A"
WORK_TYPES = ["Remote", "Hybrid", "In-Office"]
NULL_WORD = "Null"
DEFAULT_WORK_TYPE = "In-Office"

WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def to_id(c: Column) -> Column:
    """Text id to BIGINT; text that is no number gives NULL, to be reported and not to fail the batch."""
    return c.try_cast("bigint")


def sentinel_to_null(c: Column, sentinel: str = MISSING) -> Column:
    return F.nullif(c, F.lit(sentinel))


def plain_url(url: Column) -> Column:
    """An address without query string, fragment and closing slashes: one company, one url."""
    return F.rtrim(F.regexp_extract(url, "^[^?#]*", 0), F.lit("/"))


def city_of(location: Column) -> Column:
    """The part before the first comma."""
    return F.substring_index(location, ",", 1)


def applicants_of(text: Column) -> Column:
    """A leading plain number, else NULL ("Over 200 applicants", "1,234 applicants")."""
    return F.substring_index(text, " ", 1).try_cast("int")


def published_or(published: Column, seen: Column, dtype: str) -> Column:
    """The publish time if it parses as ``dtype``, else the time the row was seen."""
    return F.coalesce(published.try_cast(dtype), seen)


def strip_code(region: Column) -> Column:
    """``"0114 Name"`` without the four-digit code and the space."""
    return F.substr(region, F.lit(6))


def strip_space(c: Column) -> Column:
    """Drop leading and trailing whitespace of any kind; ``trim`` drops spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def last_part(c: Column, sep: str = ":") -> Column:
    return F.substring_index(c, sep, -1)


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH")


def work_type_or_default(c: Column) -> Column:
    """A missing work type, or the word ``Null``, means the job is done on site."""
    return F.when(c.isNull() | (c == NULL_WORD), DEFAULT_WORK_TYPE).otherwise(c)


def is_known_work_type(c: Column) -> Column:
    return c.isNull() | c.isin([*WORK_TYPES, NULL_WORD])
