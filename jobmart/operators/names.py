"""Names that mean the same place but are not written alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters with diacritics, and the letters they are folded to.
MARKED = "åäàáâãāăąçćčďđéèêëēęěíìîïīłñńňóòôõöøōőřśšşťúùûüūůűýÿźżž"
PLAIN = "aaaaaaaaacccddeeeeeeeiiiiilnnnoooooooorssstuuuuuuuyyzzz"

#: What may stand after a municipality's name and says nothing.
SUFFIX = r"[ ,]+(kommun|municipality)$"

#: Shorter names must be equal when folded: one letter of three is no slip.
LEAST_LETTERS = 4


def folded(name: Column) -> Column:
    """Lower case without diacritics, suffix and marks; words parted by one space. Empty for NULL."""
    plain = F.translate(F.lower(F.coalesce(name, F.lit(""))), MARKED, PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(plain), SUFFIX, ""), r"[^a-z0-9_]+", " "))


def neighbourhood(name: Column) -> Column:
    """The name and all that one deletion makes of it: names at an edit distance of 1 share one of these."""
    places = F.sequence(F.lit(1), F.length(name))
    fewer = F.transform(places, lambda i: F.concat(F.substr(name, F.lit(1), i - 1), F.substr(name, i + 1)))
    return F.when(F.length(name) > 0, F.array_distinct(F.concat(F.array(name), fewer))).otherwise(F.array().cast("array<string>"))


def match_names(names: DataFrame, known: DataFrame, name: str = "name", known_name: str = "known") -> DataFrame:
    """``(name, known, distance)``: for each distinct name the known one that it means, if there is one.

    Folded names must be equal or at an edit distance of 1. The nearest wins, then the one that is written
    alike, then the smaller. Candidates meet in an equi join on deletion neighbourhoods; no pairs are listed
    beyond those, and every pair is verified. NULL and empty names match nothing.
    """
    def spread(df: DataFrame, column: str, as_name: str) -> DataFrame:
        own = df.select(F.col(column).alias(as_name)).filter(F.col(as_name).isNotNull()).distinct() \
            .withColumn(f"_{as_name}", folded(F.col(as_name)))
        return own.select("*", F.explode(neighbourhood(F.col(f"_{as_name}"))).alias("_shared"))

    pairs = spread(names, name, "name").join(spread(known, known_name, "known"), "_shared").select("name", "known", "_name", "_known").distinct()
    distance = F.levenshtein("_name", "_known", 1)  # -1 beyond
    near = pairs.withColumn("distance", distance) \
        .filter((F.col("distance") == 0) | ((F.col("distance") == 1) & (F.least(F.length("_name"), F.length("_known")) >= LEAST_LETTERS)))
    best = F.min(F.struct("distance", (F.col("name") != F.col("known")).alias("unlike"), "known"))
    return near.groupBy("name").agg(best.alias("_best")).select("name", "_best.known", "_best.distance")
