"""Column mapping with type conversion, and feed selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnMapping:
    source: str
    target: str
    dtype: str = "string"


def map_columns(df: DataFrame, mappings: list[ColumnMapping]) -> DataFrame:
    """Pick, convert and rename; a value that does not convert becomes NULL."""
    return df.select(
        *(F.col(f"`{m.source}`").try_cast(m.dtype).alias(m.target) for m in mappings)
    )


def select_feed(df: DataFrame, codes: DataFrame, sexes: list[str], period: str) -> DataFrame:
    """Rows of one month, of the wanted sexes, whose four-digit region code is in ``codes.code``.

    The code table is a join side and not an IN list; Spark picks broadcast or shuffle by its size.
    """
    wanted = df.filter(F.col("sex").isin(sexes) & (F.col("period") == period))
    return wanted.join(
        codes.select("code").distinct(), F.substring("region", 1, 4) == F.col("code"), "left_semi"
    )
