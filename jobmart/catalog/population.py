"""Population feed to silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmart.catalog.registry import Inputs, query
from jobmart.functions import cleaning
from jobmart.operators.population import SEX_COLUMNS, pivot_sum
from jobmart.plans.population_flow import FEED_MAPPING, population_silver
from jobmart.sources import readers
from jobmart.sources.mapping import map_columns, select_feed

PERIODS = ["2024M07", "2024M08"]
PERIOD = "2024M08"
SEXES = list(SEX_COLUMNS)


@query("scan_population_csv", "SELECT region, sex, period, value FROM population_raw")
def scan_population_csv(src: Inputs):
    raw, path = src.fixture("population_raw"), src.work_dir("population_csv")
    months = [
        F.when(F.col("period") == p, F.col("value")).alias(readers.VALUE_PREFIX + p) for p in PERIODS
    ]
    raw.select("region", F.col("sex").alias(readers.SEX), *months).write.csv(
        path, header=True, encoding="ISO-8859-1", quote='"', escape="\\"
    )
    return readers.read_population_csv(src.spark, path, PERIODS)


@query("population_selection", """
SELECT region, sex, period, value FROM population_raw
WHERE period = '2024M08' AND sex IN ('män', 'kvinnor')
  AND substring(region, 1, 4) IN (SELECT code FROM region_codes)""")
def population_selection(src: Inputs):
    return select_feed(src.fixture("population_raw"), src.fixture("region_codes"), SEXES, PERIOD)


@query("population_mapped", """
SELECT region AS city, sex AS gender, TRY_CAST(value AS BIGINT) AS monthlyPopulation
FROM population_raw""")
def population_mapped(src: Inputs):
    return map_columns(src.fixture("population_raw"), FEED_MAPPING)


@query("population_pivot", """
SELECT region AS city,
  CAST(sum(CASE WHEN sex = 'män' THEN CAST(value AS BIGINT) END) AS BIGINT) AS MenPopulation,
  CAST(sum(CASE WHEN sex = 'kvinnor' THEN CAST(value AS BIGINT) END) AS BIGINT) AS WomenPopulation
FROM population_raw GROUP BY region""")
def population_pivot(src: Inputs):
    monthly = map_columns(src.fixture("population_raw"), FEED_MAPPING)
    return pivot_sum(monthly, "gender", "monthlyPopulation", SEX_COLUMNS)


@query("population_silver", """
SELECT City, MenPopulation, WomenPopulation, TotalPopulation FROM population_silver""")
def population_silver_query(src: Inputs):
    return population_silver(src.fixture("population_raw"), None, SEXES, PERIOD)


@query("strip_region_code", """
SELECT region, substring(region, 6) AS city, count(*) AS rows FROM population_raw GROUP BY 1, 2""")
def strip_region_code(src: Inputs):
    named = src.fixture("population_raw").select(
        "region", cleaning.strip_code(F.col("region")).alias("city")
    )
    return named.groupBy("region", "city").agg(F.count(F.lit(1)).alias("rows"))
