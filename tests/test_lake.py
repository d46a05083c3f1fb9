"""Runs over named tables: repeats, retries, and what a run leaves untouched."""

import pathlib
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobmart.operators.enrichment import explode_wide
from jobmart.plans import jobs_flow
from jobmart.plans.lake import JOB_DAY, SCHEMAS, Lake, run_jobs_hour, silver_jobs, vacuum
from jobmart.schemas import JOB_BRONZE
from jobmart.session import work_dir


def at(text):
    return datetime.fromisoformat(text)


def bronze(spark, *sightings):
    """Bronze rows from (id, time, description)."""
    rows = [
        tuple({"JobId": i, "JobDescription": d, "ExtractionDatetime": at(t) if t else None}.get(f.name)
              for f in JOB_BRONZE)
        for i, t, d in sightings
    ]
    return spark.createDataFrame(rows, JOB_BRONZE)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def lake(spark):
    return Lake(spark, work_dir(spark, "lake"), f"t_{uuid.uuid4().hex}_")


def shown(lake, as_of):
    return rows(silver_jobs(lake, at(as_of)).select("JobId", "JobDescription"))


def test_runs_follow_the_function_form(spark, lake):
    first = bronze(spark, ("1", "2024-01-02 10:00:00", "a"), ("2", "2024-01-02 11:00:00", "b"),
                   ("x", "2024-01-02 11:00:00", "bad"), ("5", None, "undated"))
    second = bronze(spark, ("1", "2024-01-03 10:00:00", "a2"), ("03", "2024-01-03 10:00:00", "c"))
    run_jobs_hour(lake, first, at("2024-01-02 12:00:00"))
    assert shown(lake, "2024-01-02 12:00:00") == [(1, "a"), (2, "b"), (5, "undated")]
    run_jobs_hour(lake, second, at("2024-01-03 12:00:00"))
    assert shown(lake, "2024-01-03 12:00:00") == [(1, "a"), (2, "b"), (3, "c"), (5, "undated")]

    # Later runs without news: sightings age out of bronze, jobs out of silver.
    run_jobs_hour(lake, bronze(spark), at("2024-02-02 10:30:00"))
    assert shown(lake, "2024-02-02 10:30:00") == [(1, "a2"), (2, "b"), (3, "c"), (5, "undated")]
    run_jobs_hour(lake, bronze(spark), at("2024-02-03 12:00:00"))
    assert shown(lake, "2024-02-03 12:00:00") == [(5, "undated")]
    assert lake.table("bronze.jobs").filter("JobId = 'x'").count() == 0


def test_a_repeated_run_changes_nothing(spark, lake):
    landed = bronze(spark, ("1", "2024-01-02 10:00:00", "a"), ("2", "2024-01-02 11:00:00", "b"))
    as_of = at("2024-01-02 12:00:00")
    run_jobs_hour(lake, landed, as_of, ask=lambda text: '{"Tools":["t"]}')
    once = {t: rows(lake.table(t)) for t in ("silver.jobs", "silver.enriched", "silver.followers")}
    run_jobs_hour(lake, landed, as_of, ask=lambda text: '{"Tools":["other"]}')
    assert {t: rows(lake.table(t)) for t in once} == once


def test_only_changed_days_are_rewritten(spark, lake):
    def files():
        table = lake.table("silver.jobs").withColumn("file", F.input_file_name())
        return {r.JobId: r.file for r in table.select("JobId", "file").collect()}

    run_jobs_hour(
        lake, bronze(spark, ("1", "2024-01-01 10:00:00", "a"), ("2", "2024-01-02 11:00:00", "b")),
        at("2024-01-02 12:00:00"),
    )
    before = files()
    run_jobs_hour(lake, bronze(spark, ("3", "2024-01-02 13:00:00", "c")), at("2024-01-02 14:00:00"))
    after = files()
    assert after[1] == before[1]
    assert after[2] != before[2]
    elsewhere = lake.table("silver.jobs").filter(F.to_date(jobs_flow.TIME) != F.col(JOB_DAY))
    assert elsewhere.count() == 0


def test_failed_calls_are_asked_again(spark, lake):
    landed = bronze(spark, ("1", "2024-01-02 10:00:00", "ok"), ("2", "2024-01-02 11:00:00", "not yet"))

    def picky(text):
        if text == "not yet":
            raise ValueError("down")
        return '{"Tools":["t"],"WorkType":"Remote"}'

    run_jobs_hour(lake, landed, at("2024-01-02 12:00:00"), ask=picky)
    assert [r.JobId for r in lake.table("silver.enriched").collect()] == [1]
    (failure,) = lake.table("silver.enrich_failures").collect()
    assert (failure.JobId, failure.attempts, failure.error) == (2, 1, "down")
    run_jobs_hour(lake, bronze(spark), at("2024-01-02 13:00:00"), ask=lambda text: '{"Tools":["u"]}')
    assert lake.table("silver.enrich_failures").count() == 0
    assert rows(explode_wide(lake.table("silver.enriched"))) == [
        (1, "t", None, None, "Remote"), (2, "u", None, None, "In-Office")
    ]


def test_followers_of_fresh_companies_only(spark, lake):
    landed = bronze(spark, ("1", "2024-01-02 11:30:00", "a")).withColumn("CompanyLinkedinUrl", F.lit("u1"))
    page = '<meta name="description" content="A | 1,200 followers">'
    pages = spark.createDataFrame([("u1", page), ("u2", page)], "url STRING, html STRING")
    run_jobs_hour(lake, landed, at("2024-01-02 11:59:00"), company_pages=pages)
    assert [(r.url, r.Nbr_of_followers) for r in lake.table("silver.followers").collect()] == [("u1", 1200)]


def files_of(lake):
    return set(map(str, pathlib.Path(lake.root).rglob("*.parquet")))


def test_a_run_that_failed_after_expiry_loses_no_job(spark, lake, monkeypatch):
    seen = bronze(spark, ("1", "2024-01-02 10:00:00", "a"), ("1", "2024-01-20 10:00:00", "a2"))
    run_jobs_hour(lake, seen, at("2024-01-20 12:00:00"))
    assert shown(lake, "2024-01-20 12:00:00") == [(1, "a")]
    with monkeypatch.context() as broken:
        broken.setattr("jobmart.plans.lake.update_jobs", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_jobs_hour(lake, bronze(spark), at("2024-02-04 12:00:00"))
    run_jobs_hour(lake, bronze(spark), at("2024-02-04 12:00:00"))
    assert shown(lake, "2024-02-04 12:00:00") == [(1, "a2")]


def test_jobs_seen_again_rewrite_nothing(spark, lake):
    run_jobs_hour(
        lake, bronze(spark, ("1", "2024-01-01 10:00:00", "a"), ("2", "2024-01-02 11:00:00", "b")),
        at("2024-01-02 12:00:00"),
    )
    before = {f for f in files_of(lake) if "/silver/jobs/" in f}
    run_jobs_hour(
        lake, bronze(spark, ("1", "2024-01-02 13:00:00", "a2"), ("2", "2024-01-02 13:00:00", "b2")),
        at("2024-01-02 14:00:00"),
    )
    assert {f for f in files_of(lake) if "/silver/jobs/" in f} == before
    assert shown(lake, "2024-01-02 14:00:00") == [(1, "a"), (2, "b")]


def test_an_empty_hour_writes_no_table(spark, lake):
    landed = bronze(spark, ("1", "2024-01-02 10:00:00", "a"))
    run_jobs_hour(lake, landed, at("2024-01-02 12:00:00"), ask=lambda text: '{"Tools":["t"]}')
    before = {f for f in files_of(lake) if "/runs/" not in f}
    run_jobs_hour(lake, bronze(spark), at("2024-01-02 13:00:00"), ask=lambda text: 1 / 0)
    assert {f for f in files_of(lake) if "/runs/" not in f} == before


def test_expired_days_are_deleted_and_vacuum_keeps_what_is_used(spark, lake):
    run_jobs_hour(
        lake, bronze(spark, ("1", "2024-01-02 10:00:00", "a"), ("2", "2024-01-20 10:00:00", "b")),
        at("2024-01-20 12:00:00"), ask=lambda text: '{"Tools":["t"]}',
    )
    run_jobs_hour(lake, bronze(spark, ("3", "2024-02-05 10:00:00", "c")), at("2024-02-05 12:00:00"))
    assert not any("2024-01-02" in f for f in files_of(lake) if "/runs/" not in f)
    tables_before = {t: rows(lake.table(t)) for t in SCHEMAS}
    assert vacuum(lake)
    assert {t: rows(lake.table(t)) for t in SCHEMAS} == tables_before
    assert vacuum(lake) == []
    assert [r.JobId for r in lake.table("silver.enriched").collect()] == [2]


def test_two_pages_of_one_company(spark, lake):
    landed = bronze(spark, ("1", "2024-01-02 11:30:00", "a")).withColumn("CompanyLinkedinUrl", F.lit("u1/?trk=x"))

    def page(n):
        return f'<meta name="description" content="A | {n} followers">'

    pages = spark.createDataFrame(
        [("u1", page(100), at("2024-01-02 11:00:00")), ("u1?a=b", page(200), at("2024-01-02 11:20:00"))],
        "url STRING, html STRING, fetched TIMESTAMP_NTZ",
    )
    for _ in range(2):
        run_jobs_hour(lake, landed, at("2024-01-02 11:59:00"), company_pages=pages)
        for table in ("bronze.followers", "silver.followers"):
            assert [(r.url, r.Nbr_of_followers) for r in lake.table(table).collect()] == [("u1", 200)]
    assert lake.table("silver.jobs").first().CompanyLinkedinUrl == "u1"


def test_a_publish_time_in_the_future_is_none(spark, lake):
    landed = bronze(spark, ("1", "2024-01-02 10:00:00", "a")).withColumn("publishdatetime", F.lit("2999-01-01 00:00:00"))
    run_jobs_hour(lake, landed, at("2024-01-02 12:00:00"))
    assert lake.table("silver.jobs").first().ExtractionDatetime == at("2024-01-02 10:00:00")
