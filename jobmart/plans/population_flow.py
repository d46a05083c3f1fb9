"""The monthly flow: population feed to the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobmart.operators.population import population_table
from jobmart.sources.mapping import ColumnMapping, map_columns, select_feed

FEED_MAPPING = [
    ColumnMapping("region", "city"),
    ColumnMapping("sex", "gender"),
    ColumnMapping("value", "monthlyPopulation", "bigint"),
]


def population_silver(
    feed: DataFrame, codes: DataFrame | None, sexes: list[str], period: str
) -> DataFrame:
    """Select one month of the feed, map its columns, pivot by sex. The result replaces the table."""
    if codes is None:
        chosen = feed.filter(feed["sex"].isin(sexes) & (feed["period"] == period))
    else:
        chosen = select_feed(feed, codes, sexes, period)
    return population_table(map_columns(chosen, FEED_MAPPING))
