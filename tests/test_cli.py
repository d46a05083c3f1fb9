"""The command line runs the flows on landed files."""

import json
import uuid

from jobmart.__main__ import main
from jobmart.session import work_dir
from jobmart.sources import readers


def test_jobs_hour(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    posting = {"JobId": "7", "Location": "Lund, Sk", "ExtractionDatetime": "2024-01-02T10:00:00.000001"}
    published = {**posting, "JobId": "8", "publishdatetime": "2024-01-01 08:00:00", "other": 1}
    wrong = {**posting, "JobId": "9", "ExtractionDatetime": "yesterday"}
    lines = [json.dumps(posting), "{broken", json.dumps(published), json.dumps(wrong)]
    (landing / "part.json").write_text("\n".join(lines) + "\n")
    prefix = f"cli_{uuid.uuid4().hex}_"
    main(
        ["jobs-hour", "--root", work_dir(spark, "cli"), "--prefix", prefix, "--landing", str(landing),
         "--as-of", "2024-01-02T11:00:00", "--ask", "tests.test_cli:answer"],
        spark,
    )
    job, dated = spark.table(f"{prefix}silver.jobs").orderBy("JobId").collect()
    assert dated.ExtractionDatetime.isoformat(sep=" ") == "2024-01-01 08:00:00"
    assert (job.JobId, job.City, job.ExtractionDatetime.microsecond) == (7, "Lund", 1)
    assert spark.table(f"{prefix}silver.enriched").first().Tools == ["t"]
    rejects = spark.table(f"{prefix}bronze.rejects").collect()
    assert sorted(r.line for r in rejects) == sorted([lines[1], lines[3]])
    bronze = {r.JobId: r for r in spark.table(f"{prefix}bronze.jobs").collect()}
    assert (bronze["7"].other, bronze["8"].other) == (None, "1")  # a field of some lines becomes a column


def answer(description):
    return '{"Tools":["t"]}'


def test_population_month(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    lines = [
        f'"{readers.REGION}","{readers.SEX}","{readers.VALUE_PREFIX}2024M08"',
        '"0180 Malmå","män","5"', '"0180 Malmå","kvinnor","6"',
    ]
    (feed / "feed.csv").write_bytes("\n".join(lines).encode("iso-8859-1"))
    prefix = f"cli_{uuid.uuid4().hex}_"
    main(
        ["population-month", "--root", work_dir(spark, "cli"), "--prefix", prefix, "--feed", str(feed),
         "--period", "2024M08"],
        spark,
    )
    assert tuple(spark.table(f"{prefix}silver.population").first()) == ("Malmå", 5, 6, 11)
