"""Population by city and sex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.functions.cleaning import strip_code

# The feed's words for the sexes and the columns they become.
SEX_COLUMNS = {"män": "MenPopulation", "kvinnor": "WomenPopulation"}


def pivot_sum(df: DataFrame, pivot: str, value: str, columns: dict[str, str]) -> DataFrame:
    """One row per value of all other columns, one sum column per listed pivot value.

    Pivot values outside the list still make a row, with NULL sums. Conditional sums do it in one
    aggregate that is partially reduced before the shuffle.
    """
    group = [c for c in df.columns if c not in (pivot, value)]
    return df.groupBy(*group).agg(
        *(F.sum(F.when(F.col(pivot) == v, F.col(value))).alias(n) for v, n in columns.items())
    )


def population_table(monthly: DataFrame) -> DataFrame:
    """``city, gender, monthlyPopulation`` to one row per municipality code.

    The code is dropped after grouping: two municipalities of one name stay two rows. The total is
    NULL if a side is.
    """
    sums = pivot_sum(monthly, "gender", "monthlyPopulation", SEX_COLUMNS)
    men, women = F.col("MenPopulation"), F.col("WomenPopulation")
    return sums.select(
        strip_code(F.col("city")).alias("City"),
        men.cast("int").alias("MenPopulation"),
        women.cast("int").alias("WomenPopulation"),
        (men + women).cast("int").alias("TotalPopulation"),
    )
