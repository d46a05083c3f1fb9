"""Field extraction from pages and company texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmart.catalog.registry import Inputs, query
from jobmart.functions import cleaning, followers, html
from jobmart.functions.html import Selector
from jobmart.plans import extraction
from jobmart.schemas import JOB_BRONZE


def _plain(sql: str) -> str:
    """SQL that reads the entities of the test pages; a cut-off title may end inside one."""
    quotes = f"regexp_replace({sql}, '&quot;|&quot$', '\"', 'g')"
    return f"regexp_replace({quotes}, '&amp;|&amp$', '&', 'g')"


@query("page_item_count", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS items FROM pages""")
def page_item_count(src: Inputs):
    return src.table("pages").select("page_id", html.item_count(F.col("html")).alias("items"))


@query("html_list_items", rf"""
SELECT page_id, CAST(unnest(range(len(i))) AS INTEGER) AS pos,
  regexp_extract(unnest(i), 'href="([^"]*)"', 1) AS href,
  {_plain("regexp_extract(unnest(i), '<a[^>]*>([^<]*)</a>', 1)")} AS label,
  list_reverse(string_split(regexp_extract(unnest(i), 'href="([^"]*)"', 1), '/'))[1] AS item_id
FROM (SELECT page_id, regexp_extract_all(html, '<li>.*?</li>') AS i FROM pages)""")
def html_list_items(src: Inputs):
    items = html.find_all(F.col("html"), Selector("li"))
    link = html.find(F.col("item"), Selector("a"))
    href = html.attribute(link, "href")
    return (
        src.table("pages")
        .select("page_id", F.posexplode(items).alias("pos", "item"))
        .select(
            "page_id", "pos", href.alias("href"), html.text(link).alias("label"),
            cleaning.last_part(href, "/").alias("item_id"),
        )
    )


@query("html_fields", rf"""
SELECT page_id, trim({_plain("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS title,
  trim({_plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) AS heading,
  regexp_extract(html, '<a href="([^"]*)"', 1) AS first_link,
  trim({_plain("""regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1)""")}) AS ad,
  CAST(NULL AS VARCHAR) AS absent
FROM pages""")
def html_fields(src: Inputs):
    page = F.col("html")
    return src.table("pages").select(
        "page_id",
        html.text(html.find(page, Selector("title"))).alias("title"),
        html.text(html.find(page, Selector("h1"))).alias("heading"),
        html.attribute(html.find(page, Selector("a")), "href").alias("first_link"),
        html.text(html.find(page, Selector("div", "ad"))).alias("ad"),
        html.text(html.find(page, Selector("h2", "top-card-layout__title"))).alias("absent"),
    )


@query("html_text", rf"""
SELECT page_id, array_to_string(list_filter(list_transform(
    string_split_regex(regexp_extract(html, '(?s)<article>.*</article>'), '</?[a-zA-Z][^>]*>'),
    lambda p: regexp_replace({_plain("p")}, '^\s+|\s+$', '', 'g')), lambda p: p <> ''), ' ') AS body
FROM pages""")
def html_text(src: Inputs):
    body = html.spaced_text(html.find_block(F.col("html"), Selector("article")))
    return src.table("pages").select("page_id", body.alias("body"))


@query("html_nth_item", """
SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)[1] AS first_item,
  regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)[6] AS sixth_item FROM pages""")
def html_nth_item(src: Inputs):
    items = html.blocks(html.find_block(F.col("html"), Selector("ul")), "li")
    return src.table("pages").select(
        "page_id",
        html.text(html.find(html.nth(items, 0), Selector("a"))).alias("first_item"),
        html.text(html.find(html.nth(items, 5), Selector("a"))).alias("sixth_item"),
    )


@query("job_ids_from_search", """
SELECT DISTINCT unnest([JobId, concat('9', JobId)]) AS JobId FROM jobs_raw""")
def job_ids_from_search(src: Inputs):
    return extraction.job_ids(src.fixture("search_pages"))


@query("job_detail_fields", """
SELECT JobId, JobTitle, CompanyName, CompanyLinkedinUrl, Location, TimePosting, NbrOfApplicants,
  concat(JobDescription, ' R&D and more') AS JobDescription, SeniorityLevel,
  CASE WHEN SeniorityLevel IS NOT NULL THEN EmploymentType END AS EmploymentType,
  CASE WHEN SeniorityLevel IS NOT NULL THEN JobFunction END AS JobFunction,
  CAST(NULL AS VARCHAR) AS Industries, ExtractionDatetime
FROM jobs_raw""")
def job_detail_fields(src: Inputs):
    rows = extraction.job_details(src.fixture("job_pages"), F.col("fetched"))
    return rows.select(*JOB_BRONZE.fieldNames())


POST_SQL = r"TRY_CAST(array_to_string(regexp_extract_all(post_text, '\b\d+\b'), '') AS BIGINT)"
META_SQL = (
    r"TRY_CAST(array_to_string(regexp_extract_all("
    r"regexp_extract(meta_text, '\| (.*?) f', 1), '\d+'), '') AS BIGINT)"
)


@query("company_followers_from_pages", f"""
SELECT * FROM (
  SELECT concat('https://jobs.example/c/', id) AS url, coalesce({POST_SQL}, {META_SQL}) AS Nbr_of_followers
  FROM follower_text) WHERE Nbr_of_followers IS NOT NULL""")
def company_followers_from_pages(src: Inputs):
    seen = F.lit("2024-01-30 23:00:00").cast("timestamp_ntz")
    return extraction.company_followers(src.fixture("company_pages"), seen).select(
        "url", "Nbr_of_followers"
    )


@query("id_from_urn", "SELECT urn, string_split(urn, ':')[-1] AS job_id FROM follower_text")
def id_from_urn(src: Inputs):
    return src.fixture("follower_text").select("urn", cleaning.last_part(F.col("urn")).alias("job_id"))


@query("follower_count_parse", rf"""
SELECT id, {POST_SQL} AS all_numbers,
  TRY_CAST(regexp_replace(regexp_extract(post_text, '([0-9][0-9,. ]*) followers', 1), '[,. ]', '', 'g')
    AS BIGINT) AS number_before_word,
  coalesce({POST_SQL}, {META_SQL}) AS followers FROM follower_text""")
def follower_count_parse(src: Inputs):
    post, meta = F.col("post_text"), F.col("meta_text")
    return src.fixture("follower_text").select(
        "id",
        followers.joined_numbers(post).alias("all_numbers"),
        followers.number_before_followers(post).alias("number_before_word"),
        followers.follower_count(post, meta).alias("followers"),
    )


@query("follower_count_fallback", f"SELECT id, {META_SQL} AS followers FROM follower_text")
def follower_count_fallback(src: Inputs):
    return src.fixture("follower_text").select(
        "id", followers.count_from_meta(F.col("meta_text")).alias("followers")
    )
