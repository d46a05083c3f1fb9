"""Report measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from jobmart.catalog.jobs import RETENTION_AS_OF, TS, followers_upsert
from jobmart.catalog.population import PERIOD, SEXES
from jobmart.catalog.registry import Inputs, query
from jobmart.functions import cleaning
from jobmart.operators import daily_counts, enrichment, names, timerange
from jobmart.plans import jobs_flow, population_flow, report
from jobmart.sources import tables


def _silver(src: Inputs):
    return jobs_flow.one_per_job(src.fixture("jobs_raw"))


def _population(src: Inputs):
    return population_flow.population_silver(src.fixture("population_raw"), None, SEXES, PERIOD)


def _parsed(src: Inputs):
    return enrichment.parse_answers(src.fixture("enrichment_response"))


def _register_job_counts() -> None:
    for key, column in {
        "jobs_by_seniority": "SeniorityLevel",
        "jobs_by_title": "JobTitle",
        "jobs_by_employment_type": "EmploymentType",
        "jobs_by_company": "CompanyName",
        "jobs_by_city": "City",
    }.items():
        sql = f"SELECT {column}, count(DISTINCT JobId) AS jobs FROM jobs_silver GROUP BY 1"
        query(key, sql)(lambda src, c=column: report.jobs_by(_silver(src), c))


def _register_value_counts() -> None:
    for kind, word in {"Offer": "offer", "Requirements": "requirement", "Tools": "tool"}.items():
        query(f"jobs_by_{word}", f"""
SELECT value, count(DISTINCT JobId) AS jobs FROM answers_long WHERE kind = '{kind}' GROUP BY 1""")(
            lambda src, k=kind: report.jobs_by_value(enrichment.explode_long(_parsed(src)), k)
        )


def _register_seniority_counts() -> None:
    for kind, word in {"Requirements": "requirement", "Tools": "tool"}.items():
        query(f"seniority_by_{word}", f"""
SELECT SeniorityLevel, value, count(DISTINCT JobId) AS jobs
FROM answers_long JOIN jobs_silver USING (JobId) WHERE kind = '{kind}' GROUP BY 1, 2""")(
            lambda src, k=kind: report.seniority_by_value(
                _silver(src), enrichment.explode_long(_parsed(src)), k
            )
        )


_register_job_counts()
_register_value_counts()
_register_seniority_counts()


@query("jobs_by_worktype", """
SELECT WorkType, count(DISTINCT JobId) AS jobs FROM enriched GROUP BY 1""")
def jobs_by_worktype(src: Inputs):
    return report.jobs_by_work_type(enrichment.to_lists(_parsed(src)))


@query("jobs_by_popularity", """
SELECT CASE WHEN Nbr_of_followers IS NULL THEN 'unknown' WHEN Nbr_of_followers >= 100000 THEN
    'from 100000' WHEN Nbr_of_followers >= 50000 THEN 'from 50000'
    WHEN Nbr_of_followers >= 10000 THEN 'from 10000' ELSE 'below 10000' END AS popularity,
  count(DISTINCT JobId) AS jobs
FROM jobs_silver LEFT JOIN followers_silver ON CompanyLinkedinUrl = url GROUP BY 1""")
def jobs_by_popularity(src: Inputs):
    return report.jobs_by_popularity(_silver(src), followers_upsert(src))


_POPULARITY = """
SELECT CompanyName, CompanyLinkedinUrl, Nbr_of_followers AS followers, count(*) AS jobs
FROM jobs_silver LEFT JOIN followers_silver ON CompanyLinkedinUrl = url GROUP BY 1, 2, 3"""


@query("company_popularity", _POPULARITY)
def company_popularity(src: Inputs):
    return report.company_popularity(_silver(src), followers_upsert(src))


@query("top_companies_by_followers", f"""
SELECT * FROM ({_POPULARITY}) WHERE followers IS NOT NULL
ORDER BY followers DESC, CompanyLinkedinUrl, CompanyName LIMIT 10""")
def top_companies_by_followers(src: Inputs):
    return report.top_companies(_silver(src), followers_upsert(src), 10)


@query("jobs_per_city_population", """
SELECT City, jobs, MenPopulation, WomenPopulation, TotalPopulation
FROM (SELECT City, count(*) AS jobs FROM jobs_silver GROUP BY 1)
LEFT JOIN population_silver USING (City)""")
def jobs_per_city_population(src: Inputs):
    return report.jobs_per_city(_silver(src), _population(src))


@query("population_by_gender", """
SELECT City, 'Men' AS Gender, CAST(sum(MenPopulation) AS BIGINT) AS people
FROM population_silver GROUP BY 1
UNION ALL
SELECT City, 'Women', CAST(sum(WomenPopulation) AS BIGINT) FROM population_silver GROUP BY 1
UNION ALL
SELECT City, 'All', CAST(sum(coalesce(MenPopulation, 0) + coalesce(WomenPopulation, 0)) AS BIGINT)
FROM population_silver GROUP BY 1
UNION ALL
SELECT 'All', 'All', CAST(sum(coalesce(MenPopulation, 0) + coalesce(WomenPopulation, 0)) AS BIGINT)
FROM population_silver""")
def population_by_gender(src: Inputs):
    return report.population_by_gender(_population(src))


# Every fourth job's city loses its diacritics, a letter or gets a suffix.
_WRITTEN = """CASE JobId % 4 WHEN 1 THEN translate(City, 'å', 'a') WHEN 2 THEN concat(left(City, 2), substring(City, 4))
    WHEN 3 THEN concat(upper(City), ', kommun') ELSE City END"""


def _folded_sql(column: str) -> str:
    plain = f"trim(translate(lower(coalesce({column}, '')), '{names.MARKED}', '{names.PLAIN}'))"
    return f"trim(regexp_replace(regexp_replace({plain}, '{names.SUFFIX}', ''), '[^a-z0-9_]+', ' ', 'g'))"


@query("jobs_per_city_matched", f"""
SELECT City, jobs, MatchedCity, MenPopulation, WomenPopulation, TotalPopulation FROM (
  SELECT City, count(DISTINCT JobId) AS jobs FROM (SELECT JobId, {_WRITTEN} AS City FROM jobs_silver) GROUP BY City) c
LEFT JOIN (
  SELECT a, arg_min(b, (d, a <> b, b)) AS MatchedCity FROM (
    SELECT DISTINCT a, b, levenshtein(fa, fb) AS d, least(length(fa), length(fb)) AS n
    FROM (SELECT DISTINCT {_WRITTEN} AS a, {_folded_sql(_WRITTEN)} AS fa FROM jobs_silver),
      (SELECT City AS b, {_folded_sql("City")} AS fb FROM population_silver)
    WHERE fa <> '' AND fb <> '')
  WHERE d = 0 OR d = 1 AND n >= 4 GROUP BY a) m ON c.City = m.a
LEFT JOIN population_silver p ON p.City = MatchedCity""".replace("SELECT City, jobs,", "SELECT c.City, jobs,", 1))
def jobs_per_city_matched(src: Inputs):
    return report.jobs_per_city_matched(_silver(src).withColumn("City", F.expr(_WRITTEN)), _population(src))


@query("company_popularity_as_of", """
SELECT JobId, Nbr_of_followers AS followers,
  CASE WHEN Nbr_of_followers IS NULL THEN 'unknown' WHEN Nbr_of_followers >= 100000 THEN
    'from 100000' WHEN Nbr_of_followers >= 50000 THEN 'from 50000'
    WHEN Nbr_of_followers >= 10000 THEN 'from 10000' ELSE 'below 10000' END AS popularity
FROM jobs_silver ASOF LEFT JOIN (SELECT * FROM followers_raw WHERE Nbr_of_followers IS NOT NULL) f
  ON CompanyLinkedinUrl = f.url AND ExtractionDatetime >= f.extraction_time""")
def company_popularity_as_of(src: Inputs):
    return report.job_popularity_as_of(_silver(src), src.fixture("followers_raw"), "ExtractionDatetime")


@query("jobs_by_tool_incremental", """
SELECT value, count(DISTINCT JobId) AS jobs
FROM answers_long JOIN (SELECT JobId, SeenAt FROM jobs_clean WHERE SeenAt >= TIMESTAMP '2024-01-10') USING (JobId)
WHERE kind = 'Tools' GROUP BY 1""")
def jobs_by_tool_incremental(src: Inputs):
    """Jobs that were seen on days that retention holds, per tool: two runs that share a day, then an expiry."""
    raw, path = src.fixture("jobs_raw"), src.work_dir("tool_parts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tools = enrichment.explode_long(_parsed(src)).filter(F.col("kind") == "Tools").select("JobId", "value")
    seen = raw.select(cleaning.to_id(F.col("JobId")).alias("JobId"), F.to_date(TS).alias("day"), TS)
    noon = timerange.instant(raw, TS, datetime(2024, 1, 15, 12))
    for n, run in enumerate((seen.filter(F.col(TS) < noon), seen.filter(F.col(TS) >= noon))):
        daily_counts.add_rows(run.drop(TS).join(tools, "JobId"), name, f"{path}/{n}", "day", ["value"], "JobId")
    tables.expire_days(src.spark, name, RETENTION_AS_OF, day="day")
    return daily_counts.distinct_counts(src.spark.table(name), ["value"], "jobs")
