"""Report measures over the silver tables.

Jobs are counted per group before anything is joined to them, so a company or city that holds a
third of all jobs arrives at the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.operators.asof import as_of_join
from jobmart.operators.names import match_names

# Lower bounds of the popularity groups, by followers.
POPULARITY_BOUNDS = [10_000, 50_000, 100_000]


def jobs_by(silver: DataFrame, *by: str) -> DataFrame:
    """Jobs per value. Silver holds one row per job, so rows are counted, in one small shuffle."""
    return silver.groupBy(*by).agg(F.count("JobId").alias("jobs"))


def jobs_by_value(long: DataFrame, kind: str) -> DataFrame:
    """Jobs per tool, requirement or offer."""
    return (
        long.filter(F.col("kind") == kind)
        .groupBy("value")
        .agg(F.count_distinct("JobId").alias("jobs"))
    )


def jobs_by_work_type(enriched: DataFrame) -> DataFrame:
    """Jobs per work type; in its wide form the enriched table holds many rows per job."""
    return enriched.groupBy("WorkType").agg(F.count_distinct("JobId").alias("jobs"))


def popularity_label(followers: Column, bounds: list[int]) -> Column:
    """``unknown``, ``below …`` the first bound, else ``from …`` the highest bound reached."""
    label = F.when(followers.isNull(), "unknown")
    for bound in sorted(bounds, reverse=True):
        label = label.when(followers >= bound, f"from {bound}")
    return label.otherwise(f"below {min(bounds)}")


def jobs_by_popularity(
    silver: DataFrame, followers: DataFrame, bounds: list[int] | None = None
) -> DataFrame:
    """Jobs per follower group of the posting company."""
    per_company = jobs_by(silver, "CompanyLinkedinUrl")
    known = followers.select("url", "Nbr_of_followers")
    met = per_company.join(known, per_company["CompanyLinkedinUrl"] == known["url"], "left")
    label = popularity_label(F.col("Nbr_of_followers"), bounds or POPULARITY_BOUNDS)
    return met.groupBy(label.alias("popularity")).agg(F.sum("jobs").alias("jobs"))


def company_popularity(silver: DataFrame, followers: DataFrame) -> DataFrame:
    """Companies with their followers, if known, and their jobs."""
    per_company = jobs_by(silver, "CompanyName", "CompanyLinkedinUrl")
    known = followers.select(
        F.col("url").alias("CompanyLinkedinUrl"), F.col("Nbr_of_followers").alias("followers")
    )
    return per_company.join(known, "CompanyLinkedinUrl", "left").select(
        "CompanyName", "CompanyLinkedinUrl", "followers", "jobs"
    )


def top_companies(silver: DataFrame, followers: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most followed companies that post jobs; the url settles ties."""
    return (
        company_popularity(silver, followers)
        .filter(F.col("followers").isNotNull())
        .orderBy(F.col("followers").desc(), "CompanyLinkedinUrl", "CompanyName")
        .limit(k)
    )


def jobs_per_city(silver: DataFrame, population: DataFrame) -> DataFrame:
    """Jobs per city next to its population; a city without a population row stays."""
    return jobs_by(silver, "City").join(population, "City", "left").select(
        "City", "jobs", "MenPopulation", "WomenPopulation", "TotalPopulation"
    )


def jobs_per_city_matched(silver: DataFrame, population: DataFrame) -> DataFrame:
    """As ``jobs_per_city``, with ``MatchedCity``: the municipality that a city means although it is written another way."""
    counts = jobs_by(silver, "City")
    matched = match_names(counts, population, "City", "City").select(F.col("name").alias("City"), F.col("known").alias("MatchedCity"))
    people = population.withColumnRenamed("City", "MatchedCity")
    return counts.join(matched, "City", "left").join(people, "MatchedCity", "left").select(
        "City", "jobs", "MatchedCity", "MenPopulation", "WomenPopulation", "TotalPopulation"
    )


def job_popularity_as_of(jobs: DataFrame, history: DataFrame, time: str, bounds: list[int] | None = None) -> DataFrame:
    """``JobId``, the company's followers when the job was seen, by the follower history, and the group they make."""
    found = as_of_join(jobs.select("JobId", "CompanyLinkedinUrl", time), history, "CompanyLinkedinUrl", time, "url", "extraction_time", "Nbr_of_followers")
    return found.select(
        "JobId", F.col("Nbr_of_followers").alias("followers"), popularity_label(F.col("Nbr_of_followers"), bounds or POPULARITY_BOUNDS).alias("popularity"))


def population_by_gender(population: DataFrame) -> DataFrame:
    """Inhabitants by city and gender, per city, and in all (``All`` marks a sum)."""
    long = population.select("City", "MenPopulation", "WomenPopulation").unpivot(
        "City", ["MenPopulation", "WomenPopulation"], "column", "people"
    )
    sex = F.when(F.col("column") == "MenPopulation", "Men").otherwise("Women")
    sums = long.select("City", sex.alias("Gender"), "people").rollup("City", "Gender").agg(
        F.grouping("City").alias("_all_cities"), F.grouping("Gender").alias("_all_genders"),
        F.sum("people").alias("people"),
    )
    return sums.select(
        F.when(F.col("_all_cities") == 1, "All").otherwise(F.col("City")).alias("City"),
        F.when(F.col("_all_genders") == 1, "All").otherwise(F.col("Gender")).alias("Gender"),
        "people",
    )


def seniority_by_value(silver: DataFrame, long: DataFrame, kind: str) -> DataFrame:
    """Jobs per seniority level and tool, requirement or offer."""
    levels = silver.select("JobId", "SeniorityLevel")  # one row per job
    return (
        long.filter(F.col("kind") == kind)
        .join(levels, "JobId")
        .groupBy("SeniorityLevel", "value")
        .agg(F.count_distinct("JobId").alias("jobs"))
    )
