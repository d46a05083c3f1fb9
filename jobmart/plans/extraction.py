"""Landed pages to rows: search results, job details, company pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions import followers, html
from jobmart.schemas import JOB_BRONZE


def job_ids(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Distinct job ids listed on search-result pages."""
    ids = F.transform(html.blocks(F.col(html_col), "li"), html.card_id)
    return (
        pages.select(F.explode(F.array_distinct(ids)).alias("JobId"))
        .filter(F.col("JobId").isNotNull())
        .distinct()
    )


def job_details(pages: DataFrame, seen: Column, html_col: str = "html") -> DataFrame:
    """Bronze rows from detail pages ``(JobId, html, …)`` fetched at ``seen``."""
    page = F.col(html_col)
    found = pages.select(
        "JobId",
        seen.alias("ExtractionDatetime"),
        html.attribute(html.find(page, html.COMPANY_LINK), "href").alias("CompanyLinkedinUrl"),
        html.spaced_text(html.find_block(page, html.DESCRIPTION)).alias("JobDescription"),
        html.job_texts(page).alias("_texts"),
    )
    texts = {n: F.get("_texts", F.lit(i)).alias(n) for i, n in enumerate(html.TEXT_NAMES)}
    return found.select(*(texts.get(f.name, F.col(f.name)) for f in JOB_BRONZE))


def company_followers(pages: DataFrame, seen: Column, html_col: str = "html") -> DataFrame:
    """``(url, Nbr_of_followers, extraction_time)`` from company pages ``(url, html, …)``.

    The first post that holds a number wins, else the page description; a page with neither gives no
    row, because the count is a required column.
    """
    page = F.col(html_col)
    counts = F.array_compact(F.transform(html.post_texts(page), lambda p: followers.joined_numbers(p)))
    count = F.coalesce(F.get(counts, F.lit(0)), followers.count_from_meta(html.meta_description(page)))
    return pages.select(
        "url", count.alias("Nbr_of_followers"), seen.alias("extraction_time")
    ).filter(F.col("Nbr_of_followers").isNotNull())
