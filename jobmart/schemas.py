"""Table schemas. Times are TIMESTAMP_NTZ: the clock of the landing feed, which is UTC."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*names: str, dtype: T.DataType | None = None) -> list[T.StructField]:
    return [T.StructField(n, dtype or T.StringType()) for n in names]


_NTZ = T.TimestampNTZType()

JOB_BRONZE = T.StructType(
    _fields(
        "JobId", "JobTitle", "CompanyName", "CompanyLinkedinUrl", "Location", "TimePosting",
        "NbrOfApplicants", "JobDescription", "SeniorityLevel", "EmploymentType", "JobFunction",
        "Industries",
    )
    + _fields("ExtractionDatetime", dtype=_NTZ)
)

# Some feeds state when a posting was published; where they do not, the column reads as NULL.
JOB_LANDING = T.StructType([*JOB_BRONZE, T.StructField("publishdatetime", T.StringType())])

JOB_SILVER = T.StructType(
    [T.StructField("JobId", T.LongType(), False)]
    + _fields("JobTitle", "CompanyName", "CompanyLinkedinUrl", "City")
    + _fields("NbrOfApplicants", dtype=T.IntegerType())
    + _fields("JobDescription", "SeniorityLevel", "EmploymentType", "JobFunction", "Industries")
    + _fields("ExtractionDatetime", dtype=_NTZ)
)

FOLLOWERS = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("Nbr_of_followers", T.LongType(), False),
        T.StructField("extraction_time", _NTZ),
    ]
)

# The combined form: one row per tool, requirement and offer of a job.
ENRICHED = T.StructType(
    [T.StructField("JobId", T.LongType(), False)]
    + _fields("Tools", "Requirements", "Offer", "WorkType")
)

ENRICHED_LISTS = T.StructType(
    [T.StructField("JobId", T.LongType(), False)]
    + _fields("Tools", "Requirements", "Offer", dtype=T.ArrayType(T.StringType()))
    + _fields("WorkType")
)

POPULATION_SILVER = T.StructType(
    [T.StructField("City", T.StringType(), False)]
    + _fields("MenPopulation", "WomenPopulation", "TotalPopulation", dtype=T.IntegerType())
)

# Failed calls and answers that could not be used, per job.
ENRICH_FAILURES = T.StructType(
    [
        T.StructField("JobId", T.LongType(), False),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("last_try", _NTZ),
    ]
)

# Landed lines that could not be read.
REJECTS = T.StructType(_fields("line") + _fields("seen", dtype=_NTZ))
