"""Postings and followers: scans, cleaning, time ranges, dedup, merges, table writes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from jobmart.catalog.registry import Inputs, query
from jobmart.functions import cleaning
from jobmart.operators import checks, dedup, intervals, merge, timerange
from jobmart.plans import jobs_flow
from jobmart.schemas import FOLLOWERS, JOB_BRONZE, JOB_LANDING, JOB_SILVER
from jobmart.sources import buckets, readers, tables

HOUR_AS_OF = datetime(2024, 1, 30, 23, 30)
RETENTION_AS_OF = datetime(2024, 2, 10)
SPLIT = datetime(2024, 1, 15)
TS = "ExtractionDatetime"

SILVER = ", ".join(f.name for f in JOB_SILVER)
BRONZE = ", ".join(f.name for f in JOB_BRONZE)


def _before(df):
    return df.filter(F.col(TS) < timerange.instant(df, TS, SPLIT))


def _after(df):
    return df.filter(F.col(TS) >= timerange.instant(df, TS, SPLIT))


# --- sources and sinks ------------------------------------------------------------------------


@query("scan_bronze_jobs", f"""
SELECT {BRONZE}, CAST(ExtractionDatetime AS VARCHAR) AS ExtractionText FROM jobs_raw""")
def scan_bronze_jobs(src: Inputs):
    path = src.work_dir("landing")
    src.fixture("jobs_raw").write.option("timestampNTZFormat", readers.NTZ_FORMAT).json(path)
    landed = readers.read_landing(src.spark, path, JOB_BRONZE)
    return landed.withColumn("ExtractionText", F.col(TS).cast("string"))


@query("append_evolving_schema", f"""
SELECT {BRONZE}, CASE WHEN ExtractionDatetime >= TIMESTAMP '2024-01-15' THEN publishdatetime END
  AS publishdatetime FROM jobs_raw""")
def append_evolving_schema(src: Inputs):
    raw, path = src.fixture("jobs_raw"), src.work_dir("bronze")
    tables.append_evolving(_before(raw).drop("publishdatetime"), path)
    tables.append_evolving(_after(raw), path)
    return tables.read_evolving(src.spark, path)


@query("landing_new_column", """
SELECT JobId, ExtractionDatetime, CASE WHEN EmploymentType = 'Contract' AND ExtractionDatetime >= TIMESTAMP '2024-01-15'
  THEN concat(JobFunction, ' pay') END AS Salary, CASE WHEN ExtractionDatetime >= TIMESTAMP '2024-01-15'
  THEN CAST(length(JobTitle) AS VARCHAR) END AS TitleLength
FROM jobs_raw""")
def landing_new_column(src: Inputs):
    """Later lines have fields that the landing schema does not know, one of them in some lines only."""
    raw, path = src.fixture("jobs_raw"), src.work_dir("bronze")
    pay = F.when(F.col("EmploymentType") == "Contract", F.concat("JobFunction", F.lit(" pay")))
    later = _after(raw).withColumns({"Salary": pay, "TitleLength": F.length("JobTitle")})
    for part in (_before(raw), later):
        landing = src.work_dir("landing")
        part.write.option("timestampNTZFormat", readers.NTZ_FORMAT).json(landing)
        noted = tables.land(readers.read_rescued(src.spark, landing, JOB_LANDING), src.work_dir("landed"))
        tables.append_evolving(readers.readable(readers.with_new_columns(noted)), path)
    return tables.read_evolving(src.spark, path).select("JobId", TS, "Salary", "TitleLength")


@query("landing_rescued_keys", """
SELECT 'Salary' AS key, count(*) AS n FROM jobs_raw WHERE EmploymentType = 'Contract' HAVING count(*) > 0
UNION ALL SELECT 'title-length', count(*) FROM jobs_raw WHERE JobTitle IS NOT NULL HAVING count(*) > 0""")
def landing_rescued_keys(src: Inputs):
    raw, landing = src.fixture("jobs_raw"), src.work_dir("landing")
    pay = F.when(F.col("EmploymentType") == "Contract", F.concat("JobFunction", F.lit(" pay")))
    raw.withColumns({"Salary": pay, "title-length": F.length("JobTitle")}) \
        .write.option("timestampNTZFormat", readers.NTZ_FORMAT).json(landing)
    return readers.rescued_keys(readers.read_rescued(src.spark, landing, JOB_LANDING))


@query("union_evolving_schema", f"""
SELECT {BRONZE}, CASE WHEN ExtractionDatetime >= TIMESTAMP '2024-01-15' THEN publishdatetime END
  AS publishdatetime FROM jobs_raw""")
def union_evolving_schema(src: Inputs):
    raw = src.fixture("jobs_raw")
    return tables.union_evolving(_before(raw).drop("publishdatetime"), _after(raw))


@query("overwrite_new_schema", """
SELECT JobId, CAST(event_count AS BIGINT) AS sightings FROM (
  SELECT JobId, count(*) AS event_count FROM jobs_raw GROUP BY JobId)""")
def overwrite_new_schema(src: Inputs):
    raw, path = src.fixture("jobs_raw"), src.work_dir("replaced")
    tables.overwrite_new_schema(raw.select("JobId", "JobTitle"), path)
    counts = raw.groupBy("JobId").agg(F.count(F.lit(1)).alias("sightings"))
    return tables.overwrite_new_schema(counts, path)


def _external(src: Inputs, purpose: str):
    """The postings as a named external table; returns the name."""
    path = src.work_dir(purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    src.fixture("jobs_raw").write.parquet(path)
    tables.register_external(src.spark, name, path)
    return name


@query("overwrite_swap", f"""
SELECT {BRONZE}, publishdatetime FROM jobs_raw
WHERE NOT coalesce(date_sub('day', ExtractionDatetime, TIMESTAMP '2024-02-10') > 30, false)""")
def overwrite_swap(src: Inputs):
    name = _external(src, "swapped")
    kept = timerange.retain(src.spark.table(name), TS, RETENTION_AS_OF)
    return tables.swap_table(kept, name, src.work_dir("swapped_v2"))


@query("external_table_scan", "SELECT JobId, JobTitle, ExtractionDatetime FROM jobs_raw")
def external_table_scan(src: Inputs):
    name = _external(src, "external")
    view = f"{name}_view"
    src.spark.table(name).createOrReplaceTempView(view)
    return src.spark.sql(f"SELECT JobId, JobTitle, ExtractionDatetime FROM {view}")


@query("not_null_violations", """
SELECT JobTitle, SeenAt, array_to_string(list_filter([
    CASE WHEN JobId IS NULL THEN 'JobId' END,
    CASE WHEN CompanyName IS NULL THEN 'CompanyName' END], lambda v: v IS NOT NULL), ',') AS violated
FROM jobs_clean WHERE JobId IS NULL OR CompanyName IS NULL""")
def not_null_violations(src: Inputs):
    clean = jobs_flow.clean_jobs(src.fixture("jobs_raw"))
    return checks.null_violations(clean, ["JobId", "CompanyName"]).select(
        "JobTitle", "SeenAt", "violated"
    )


@query("duplicate_job_ids", """
SELECT JobId, count(*) AS rows FROM jobs_clean GROUP BY JobId HAVING count(*) > 1""")
def duplicate_job_ids(src: Inputs):
    return checks.duplicate_keys(jobs_flow.clean_jobs(src.fixture("jobs_raw")), ["JobId"])


# --- cleaning ---------------------------------------------------------------------------------


@query("jobs_clean_projection", f"SELECT {SILVER}, SeenAt FROM jobs_clean")
def jobs_clean_projection(src: Inputs):
    return jobs_flow.clean_jobs(src.fixture("jobs_raw"))


@query("null_sentinels", """
SELECT JobId, ExtractionDatetime, nullif(CompanyName, 'N/A') AS CompanyName,
  nullif(CompanyLinkedinUrl, 'N/A') AS CompanyLinkedinUrl FROM jobs_raw""")
def null_sentinels(src: Inputs):
    names = ["CompanyName", "CompanyLinkedinUrl"]
    return src.fixture("jobs_raw").select(
        "JobId", TS, *(cleaning.sentinel_to_null(F.col(n)).alias(n) for n in names)
    )


@query("city_from_location", """
SELECT JobId, ExtractionDatetime, Location, string_split(Location, ',')[1] AS City FROM jobs_raw""")
def city_from_location(src: Inputs):
    return src.fixture("jobs_raw").select(
        "JobId", TS, "Location", cleaning.city_of(F.col("Location")).alias("City")
    )


@query("applicants_parse", """
SELECT JobId, ExtractionDatetime, NbrOfApplicants AS applicants_text,
  TRY_CAST(string_split(NbrOfApplicants, ' ')[1] AS INTEGER) AS applicants FROM jobs_raw""")
def applicants_parse(src: Inputs):
    text = F.col("NbrOfApplicants")
    return src.fixture("jobs_raw").select(
        "JobId", TS, text.alias("applicants_text"), cleaning.applicants_of(text).alias("applicants")
    )


@query("publish_time_fallback", """
SELECT JobId, ExtractionDatetime, publishdatetime,
  coalesce(TRY_CAST(publishdatetime AS TIMESTAMP), ExtractionDatetime) AS published FROM jobs_raw""")
def publish_time_fallback(src: Inputs):
    published = cleaning.published_or(F.col("publishdatetime"), F.col(TS), "timestamp_ntz")
    return src.fixture("jobs_raw").select(
        "JobId", TS, "publishdatetime", published.alias("published")
    )


# --- time ranges and retention ----------------------------------------------------------------


@query("jobs_in_hour", """
SELECT JobId, JobTitle, ExtractionDatetime FROM jobs_raw
WHERE strftime(ExtractionDatetime, '%Y-%m-%d %H') = '2024-01-30 23'""")
def jobs_in_hour(src: Inputs):
    return timerange.in_hour(src.fixture("jobs_raw"), TS, HOUR_AS_OF).select("JobId", "JobTitle", TS)


@query("hour_bucket_label", """
SELECT strftime(ExtractionDatetime, '%Y-%m-%d %H') AS hour, count(*) AS sightings
FROM jobs_raw GROUP BY 1""")
def hour_bucket_label(src: Inputs):
    return src.fixture("jobs_raw").groupBy(cleaning.hour_label(F.col(TS)).alias("hour")).agg(
        F.count(F.lit(1)).alias("sightings")
    )


@query("fresh_company_urls", """
SELECT DISTINCT CompanyLinkedinUrl AS url FROM jobs_raw
WHERE strftime(ExtractionDatetime, '%Y-%m-%d %H') = '2024-01-30 23'
  AND CompanyLinkedinUrl IS NOT NULL AND CompanyLinkedinUrl <> ''""")
def fresh_company_urls(src: Inputs):
    return jobs_flow.fresh_company_urls(src.fixture("jobs_raw"), HOUR_AS_OF)


@query("age_in_days", """
SELECT JobId, ExtractionDatetime,
  CAST(date_sub('day', ExtractionDatetime, TIMESTAMP '2024-02-10') AS BIGINT) AS age FROM jobs_raw""")
def age_in_days(src: Inputs):
    raw = src.fixture("jobs_raw")
    return raw.select("JobId", TS, timerange.age_in_days(raw, TS, RETENTION_AS_OF).alias("age"))


_KEPT = """
SELECT JobId, ExtractionDatetime FROM jobs_raw
WHERE NOT coalesce(date_sub('day', ExtractionDatetime, TIMESTAMP '2024-02-10') > 30, false)"""


@query("retention_keep", _KEPT)
def retention_keep(src: Inputs):
    return timerange.retain(src.fixture("jobs_raw"), TS, RETENTION_AS_OF).select("JobId", TS)


@query("retention_expired", """
SELECT JobId, ExtractionDatetime FROM jobs_raw
WHERE date_sub('day', ExtractionDatetime, TIMESTAMP '2024-02-10') > 30""")
def retention_expired(src: Inputs):
    return timerange.expired(src.fixture("jobs_raw"), TS, RETENTION_AS_OF).select("JobId", TS)


@query("retention_by_day", _KEPT)
def retention_by_day(src: Inputs):
    path = src.work_dir("by_day")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.write_by_day(src.fixture("jobs_raw"), name, path, TS)
    tables.expire_days(src.spark, name, RETENTION_AS_OF)
    return timerange.retain(src.spark.table(name), TS, RETENTION_AS_OF).select("JobId", TS)


# --- dedup ------------------------------------------------------------------------------------


@query("distinct_job_ids", "SELECT DISTINCT JobId FROM jobs_raw")
def distinct_job_ids(src: Inputs):
    return dedup.distinct_keys(src.fixture("jobs_raw"), "JobId")


@query("jobs_dedup_first", f"SELECT {SILVER} FROM jobs_silver")
def jobs_dedup_first(src: Inputs):
    return jobs_flow.one_per_job(src.fixture("jobs_raw"))


@query("jobs_dedup_last", f"""
SELECT {SILVER} FROM (
  SELECT *, row_number() OVER (PARTITION BY JobId ORDER BY SeenAt DESC) AS rn
  FROM jobs_clean WHERE JobId IS NOT NULL) WHERE rn = 1""")
def jobs_dedup_last(src: Inputs):
    return jobs_flow.one_per_job(src.fixture("jobs_raw"), keep="last")


# --- merges -----------------------------------------------------------------------------------


def _first(where: str) -> str:
    return f"""(SELECT {SILVER}, SeenAt FROM (
  SELECT *, row_number() OVER (PARTITION BY JobId ORDER BY SeenAt) AS rn
  FROM jobs_clean WHERE JobId IS NOT NULL AND {where}) WHERE rn = 1)"""


_UPSERT = f"""
SELECT {SILVER} FROM {_first("SeenAt >= TIMESTAMP '2024-01-15'")}
UNION ALL
SELECT {SILVER} FROM {_first("SeenAt < TIMESTAMP '2024-01-15'")}
WHERE JobId NOT IN (
  SELECT JobId FROM jobs_clean WHERE JobId IS NOT NULL AND SeenAt >= TIMESTAMP '2024-01-15')"""


@query("jobs_upsert", _UPSERT)
def jobs_upsert(src: Inputs):
    raw = src.fixture("jobs_raw")
    target, source = jobs_flow.one_per_job(_before(raw)), jobs_flow.one_per_job(_after(raw))
    return merge.upsert(target, source, ["JobId"])


@query("jobs_upsert_bucketed", _UPSERT)
def jobs_upsert_bucketed(src: Inputs):
    raw, path = src.fixture("jobs_raw"), src.work_dir("jobs_bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    target, source = jobs_flow.one_per_job(_before(raw)), jobs_flow.one_per_job(_after(raw))
    buckets.write_bucketed(target, name, f"{path}/0", ["JobId"], 8)
    return buckets.upsert_bucketed(name, source, f"{name}_next", f"{path}/1", ["JobId"], 8)


# Bronze at the second run has lost what was 31 days old by then, so a job's first sighting may be a
# later one than silver holds; silver then follows bronze.
TWO_RUNS = (datetime(2024, 1, 15), datetime(2024, 2, 4))


TWO_RUNS_SQL = f"""
SELECT {SILVER} FROM (
  SELECT {SILVER} FROM {_first("SeenAt > TIMESTAMP '2024-01-04'")}
  UNION ALL
  SELECT {SILVER} FROM {_first("SeenAt < TIMESTAMP '2024-01-15'")}
  WHERE JobId NOT IN (
    SELECT JobId FROM jobs_clean WHERE JobId IS NOT NULL AND SeenAt > TIMESTAMP '2024-01-04'))
WHERE ExtractionDatetime > TIMESTAMP '2024-01-04'"""


@query("jobs_upsert_two_batches", TWO_RUNS_SQL)
def jobs_upsert_two_batches(src: Inputs):
    raw = src.fixture("jobs_raw")
    first, second = TWO_RUNS
    silver = readers.empty_table(src.spark, JOB_SILVER)
    bronze = jobs_flow.bronze_after(readers.empty_table(src.spark, raw.schema), _before(raw), first)
    silver = jobs_flow.silver_jobs_after(silver, bronze, first)
    bronze = jobs_flow.bronze_after(bronze, _after(raw), second)
    return jobs_flow.silver_jobs_after(silver, bronze, second)


@query("company_url_normalised", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL
  ELSE concat('https://jobs.example/c/', user_id % 50) END AS url FROM events""")
def company_url_normalised(src: Inputs):
    user = F.col("user_id") % 50
    n = F.col("event_id") % 5
    raw = F.concat(F.lit("https://jobs.example/c/"), user, F.when(n == 1, "/").when(n == 2, "?trk=a/b").when(n == 3, "/#top").otherwise(""))
    written = F.when(n != 0, raw)
    return src.table("events").select("event_id", cleaning.plain_url(written).alias("url"))


@query("landing_rejects", """
SELECT concat('{"JobId":"', event_id, '",') AS line FROM events WHERE event_id % 10 = 3
UNION ALL
SELECT concat('{"JobId":"', event_id, '","ExtractionDatetime":"soon"}') FROM events WHERE event_id % 10 = 4""")
def landing_rejects(src: Inputs):
    """Landed lines of which some are cut off and some hold no time where one is due."""
    n = F.col("event_id") % 10
    tail = F.when(n == 3, ",").when(n == 4, ',"ExtractionDatetime":"soon"}').otherwise("}")
    path = src.work_dir("landing")
    line = F.concat(F.lit('{"JobId":"'), F.col("event_id"), F.lit('"'), tail)
    src.table("events").select(line.alias("value")).write.text(path)
    noted = tables.land(readers.read_noted(src.spark, path, JOB_LANDING), src.work_dir("landed"))
    return readers.rejected(noted)


def _batch(src: Inputs, number: int):
    raw = src.fixture("followers_raw")
    return raw.filter(F.col("batch") == number).drop("batch")


@query("followers_distinct", """
SELECT DISTINCT url, Nbr_of_followers, extraction_time FROM follower_sightings""")
def followers_distinct(src: Inputs):
    return dedup.distinct_keys(
        src.fixture("follower_sightings"), "url", "Nbr_of_followers", "extraction_time"
    )


@query("followers_upsert", "SELECT url, Nbr_of_followers, extraction_time FROM followers_silver")
def followers_upsert(src: Inputs):
    silver = jobs_flow.followers_after(readers.empty_table(src.spark, FOLLOWERS), _batch(src, 1))
    return jobs_flow.followers_after(silver, _batch(src, 2))


@query("followers_batch_upsert", """
SELECT url, Nbr_of_followers, extraction_time FROM followers_raw WHERE batch = 2
UNION ALL
SELECT url, Nbr_of_followers, extraction_time FROM followers_raw
WHERE batch = 1 AND url NOT IN (SELECT url FROM followers_raw WHERE batch = 2)""")
def followers_batch_upsert(src: Inputs):
    return merge.upsert(_batch(src, 1), _batch(src, 2), ["url"])


@query("empty_batch_noop", """
SELECT url, Nbr_of_followers, extraction_time FROM followers_raw WHERE batch = 1""")
def empty_batch_noop(src: Inputs):
    return merge.upsert(_batch(src, 1), readers.empty_table(src.spark, FOLLOWERS), ["url"])


@query("landing_quality", """
SELECT 'rows' AS check, count(*) AS n FROM jobs_raw
UNION ALL SELECT 'null JobTitle', count(*) FROM jobs_raw WHERE JobTitle IS NULL
UNION ALL SELECT 'null NbrOfApplicants', count(*) FROM jobs_raw WHERE NbrOfApplicants IS NULL
UNION ALL SELECT 'null SeniorityLevel', count(*) FROM jobs_raw WHERE SeniorityLevel IS NULL
UNION ALL SELECT 'id is no number', count(*) FROM jobs_raw WHERE TRY_CAST(JobId AS BIGINT) IS NULL
UNION ALL SELECT 'no publish time', count(*) FROM jobs_raw WHERE TRY_CAST(publishdatetime AS TIMESTAMP) IS NULL""")
def landing_quality(src: Inputs):
    """Counted in the write that lands the batch."""
    landing = src.work_dir("landing")
    src.fixture("jobs_raw").write.option("timestampNTZFormat", readers.NTZ_FORMAT).json(landing)
    watched, seen = checks.observed(readers.read_landing(src.spark, landing, JOB_LANDING), ["JobTitle", "NbrOfApplicants", "SeniorityLevel"], {
        "id is no number": cleaning.to_id(F.col("JobId")).isNull(),
        "no publish time": F.col("publishdatetime").try_cast("timestamp_ntz").isNull(),
    })
    tables.land(watched, src.work_dir("landed"))
    return checks.counts_of(src.spark, seen)


_CHANGING = ["NbrOfApplicants", "JobTitle", "SeniorityLevel"]
_SAME = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER in_time" for c in _CHANGING)


@query("job_intervals", f"""
SELECT JobId, {", ".join(_CHANGING)}, greatest(valid_from, TIMESTAMP '2024-01-10 00:00:00') AS valid_from, valid_to, last_seen
FROM (
  SELECT *, lead(valid_from) OVER (PARTITION BY JobId ORDER BY valid_from) AS valid_to FROM (
    SELECT JobId, run, {", ".join(f"any_value({c}) AS {c}" for c in _CHANGING)}, min(SeenAt) AS valid_from, max(SeenAt) AS last_seen
    FROM (SELECT *, sum(begins) OVER (PARTITION BY JobId ORDER BY SeenAt) AS run FROM (
      SELECT *, CASE WHEN lag(SeenAt) OVER in_time IS NOT NULL AND {_SAME} THEN 0 ELSE 1 END AS begins
      FROM (SELECT *, row_number() OVER (PARTITION BY JobId, SeenAt ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _CHANGING)}) AS rn
        FROM jobs_clean WHERE JobId IS NOT NULL)
      WHERE rn = 1 WINDOW in_time AS (PARTITION BY JobId ORDER BY SeenAt)))
    GROUP BY JobId, run))
WHERE valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-10 00:00:00'""")
def job_intervals(src: Inputs):
    """Two batches folded one after the other, then cut at what retention keeps."""
    raw = src.fixture("jobs_raw")
    before, after = (jobs_flow.sightings(part) for part in (_before(raw), _after(raw)))
    first = tables.land(intervals.change_intervals(before, ["JobId"], _CHANGING, jobs_flow.SEEN), src.work_dir("intervals"))
    both = intervals.intervals_after(first, after, ["JobId"], _CHANGING, jobs_flow.SEEN)
    return intervals.since(both, datetime(2024, 1, 10))
