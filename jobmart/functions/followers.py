"""Follower counts from company-page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_numbers(text: Column, pattern: str = r"\b\d+\b") -> Column:
    """All numbers in the text written one after the other: ``"12,345 followers"`` is 12345."""
    return F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "").try_cast("bigint")


def number_before_followers(text: Column) -> Column:
    """Stricter form: only the number right before the word, so other numbers do not run into it."""
    digits = F.regexp_extract(text, r"([0-9][0-9,. ]*) followers", 1)
    return F.regexp_replace(digits, "[,. ]", "").try_cast("bigint")


def count_from_meta(text: Column) -> Column:
    """The number between ``"| "`` and the next ``" f"`` of the page description."""
    return joined_numbers(F.regexp_extract(text, r"\| (.*?) f", 1), r"\d+")


def follower_count(post: Column, meta: Column) -> Column:
    """From the post text if that parses, else from the page description, else NULL."""
    return F.coalesce(joined_numbers(post), count_from_meta(meta))
