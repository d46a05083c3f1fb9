"""Words and rolling word n-gram hashes as column expressions: nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Everything in ASCII that is no letter or digit; other characters belong to words.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_words(text: Column, separators: str = NO_WORD) -> Column:
    """The words of a lower-cased text; none for NULL."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), separators), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def doubled(grams: Column, width: int) -> Column:
    """Hashes of the 2 * ``width``-grams that start at each position, from those of the ``width``-grams.

    The last positions, where no whole gram starts, hold other values; ``complete`` cuts them.
    """
    return F.zip_with(grams, F.slice(grams, width + 1, F.size(grams)), lambda a, b: F.xxhash64(a, b))


def rolled(df: DataFrame, column: str, width: int, have: int = 1) -> DataFrame:
    """``df`` with the hashes of all ``width``-grams (a power of two) in ``column``, which holds those of
    ``have`` words.

    Every doubling is a projection of its own: within one expression Spark would compute the shorter
    grams anew wherever they are mentioned.
    """
    while have < width:
        df, have = df.withColumn(column, doubled(F.col(column), have)), 2 * have
    return df


def complete(grams: Column, n_words: Column, width: int) -> Column:
    """Only the positions at which a whole gram starts."""
    return F.slice(grams, 1, F.greatest(n_words - (width - 1), F.lit(0)))
