"""Derived inputs: the lakehouse's landing tables, as SELECTs over the driver tables.

The text is accepted by Spark and DuckDB alike. Every input grows with the tables it reads. A third of
the postings belong to one company, and sightings per job repeat, so the keys are skewed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

FIXTURES = {
    # Bronze postings: many sightings per job, ids with leading zeros and broken ids, N/A and empty
    # companies, applicants and publish times that do not parse.
    "jobs_raw": """
SELECT concat(CASE WHEN event_id % 97 = 0 THEN 'x' WHEN event_id % 5 = 1 THEN '00' ELSE '' END,
    CAST(user_id * 10 + CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
      WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS STRING)) AS JobId,
  concat(event_type, ' role ', CAST(user_id % 7 AS STRING)) AS JobTitle,
  CASE WHEN user_id % 10 = 0 THEN 'N/A' WHEN user_id % 3 = 0 THEN 'Company 3'
    ELSE concat('Company ', CAST(user_id AS STRING)) END AS CompanyName,
  CASE WHEN user_id % 10 = 0 THEN 'N/A' WHEN user_id % 3 = 0 THEN 'https://jobs.example/c/3'
    WHEN user_id % 10 = 1 THEN ''
    ELSE concat('https://jobs.example/c/', CAST(user_id AS STRING)) END AS CompanyLinkedinUrl,
  CASE WHEN user_id % 50 = 49 THEN ''
    ELSE concat('NATION_', CAST(user_id % 25 AS STRING), 'å, Region, Country') END AS Location,
  CAST(NULL AS STRING) AS TimePosting,
  CASE event_id % 5 WHEN 0 THEN concat(CAST(event_id % 200 AS STRING), ' applicants')
    WHEN 1 THEN 'Over 200 applicants' WHEN 2 THEN 'Be among the first 25 applicants'
    WHEN 3 THEN concat(CAST(event_id % 9 + 1 AS STRING), ',234 applicants') ELSE NULL
    END AS NbrOfApplicants,
  concat('Description ', CAST(event_id AS STRING)) AS JobDescription,
  CASE user_id % 4 WHEN 0 THEN 'Entry level' WHEN 1 THEN 'Associate' WHEN 2 THEN 'Mid-Senior level'
    ELSE NULL END AS SeniorityLevel,
  CASE user_id % 3 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part-time' ELSE 'Contract'
    END AS EmploymentType,
  event_type AS JobFunction,
  concat('Industry ', CAST(user_id % 5 AS STRING)) AS Industries,
  CASE event_id % 3 WHEN 0 THEN 'not a time' WHEN 1 THEN NULL
    ELSE concat('2024-01-', lpad(CAST(event_id % 28 + 1 AS STRING), 2, '0'), ' 08:00:00')
    END AS publishdatetime,
  ts AS ExtractionDatetime
FROM {events}""",
    # Population feed: code and name with a non-ASCII letter, a sex outside the list, codes without
    # women, two months, values as text.
    "population_raw": """
SELECT concat(lpad(CAST(n_nationkey AS STRING), 4, '0'), ' ', n_name, 'å') AS region,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'män'
    WHEN c_mktsegment = 'HOUSEHOLD' AND n_nationkey % 6 <> 0 THEN 'kvinnor'
    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'män' ELSE 'other' END AS sex,
  CASE WHEN c_custkey % 2 = 0 THEN '2024M08' ELSE '2024M07' END AS period,
  CAST(c_custkey % 1000 + 1 AS STRING) AS value
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "region_codes": """
SELECT lpad(CAST(n_nationkey AS STRING), 4, '0') AS code
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_regionkey <> 0""",
    # Two follower batches that overlap in one market segment; the first has missing counts.
    "followers_raw": """
SELECT 1 AS batch, concat('https://jobs.example/c/', CAST(c_custkey AS STRING)) AS url,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey * 100 + 1 END AS Nbr_of_followers,
  TIMESTAMP '2024-01-15 00:00:00' AS extraction_time
FROM {customer} WHERE c_mktsegment <> 'BUILDING'
UNION ALL
SELECT 2, concat('https://jobs.example/c/', CAST(c_custkey AS STRING)), c_custkey * 100 + 2,
  TIMESTAMP '2024-01-16 00:00:00'
FROM {customer} WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')""",
    # The same company looked up once per order: many equal rows.
    "follower_sightings": """
SELECT concat('https://jobs.example/c/', CAST(o_custkey AS STRING)) AS url,
  o_custkey * 100 + 1 AS Nbr_of_followers, TIMESTAMP '2024-01-15 00:00:00' AS extraction_time
FROM {orders}""",
    "job_descriptions": """
SELECT doc_id AS JobId, text AS JobDescription FROM {documents}""",
    # Enriched rows: jobs that carry a label are done; conversations stand for jobs that are gone,
    # with one row per turn.
    "enriched_seed": """
SELECT doc_id AS JobId, concat('seed', CAST(quality AS STRING)) AS Tools,
  CAST(NULL AS STRING) AS Requirements, CAST(NULL AS STRING) AS Offer, 'Remote' AS WorkType
FROM {labels}
UNION ALL
SELECT -1 - conv_id, concat('turn', CAST(turn AS STRING)), NULL, NULL, 'Hybrid'
FROM {conversations}""",
    # Model answers: bad JSON, empty lists, a word for a list, extra and missing keys, odd work types.
    "enrichment_response": """
SELECT doc_id AS JobId, CASE doc_id % 8
  WHEN 0 THEN 'not json'
  WHEN 1 THEN '{{"Tools":[],"Requirements":[],"Offer":[],"WorkType":null}}'
  WHEN 2 THEN '{{"Tools":"solo","Requirements":["r1"],"Offer":["o1"],"WorkType":"Null"}}'
  WHEN 3 THEN '{{"Tools":["t1"],"extra":1}}'
  WHEN 4 THEN '{{"Tools":["t1"],"Requirements":["r1"],"Offer":["o1"],"WorkType":"On the moon"}}'
  ELSE concat('{{"Tools":["t', CAST(doc_id % 5 AS STRING), '","', source,
    '"],"Requirements":["r', CAST(doc_id % 4 AS STRING), '","', lang,
    '"],"Offer":["o', CAST(doc_id % 3 AS STRING), '"],"WorkType":"',
    CASE WHEN doc_id % 2 = 0 THEN 'Remote' ELSE 'Hybrid' END, '"}}') END AS response
FROM {documents}""",
    # Texts of company pages: no post, a post without a number, separators, no match in the meta text.
    "follower_text": """
SELECT c_custkey AS id, concat('urn:x:job:', CAST(c_custkey AS STRING)) AS urn,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'no number here'
    WHEN c_custkey % 5 = 2 THEN concat('24 h ago ', CAST(c_custkey % 90 + 1 AS STRING), ',234 followers')
    ELSE concat(CAST(c_custkey % 90 + 1 AS STRING), ',',
      lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), ' followers') END AS post_text,
  CASE WHEN c_custkey % 7 = 0 THEN 'nothing' ELSE concat('Acme | ',
    CAST(c_custkey % 90 + 1 AS STRING), ',', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'),
    ' followers on Site') END AS meta_text
FROM {customer}""",
    "company_pages": """
SELECT concat('https://jobs.example/c/', CAST(id AS STRING)) AS url,
  concat('<html><head><meta charset="utf-8"><meta name="description" content="', meta_text,
    '"></head><body><ul>',
    CASE WHEN post_text IS NULL THEN '' ELSE concat(
      '<li class="mb-1"><p>News &amp; more</p></li><li class="x mb-1"><p> ', post_text,
      ' </p></li>') END,
    '<li class="mb-12"><p>7</p></li></ul></body></html>') AS html
FROM follower_text""",
    # Result pages: a div card, a link card, and an item without a card.
    "search_pages": """
SELECT ExtractionDatetime AS fetched, concat(
  '<li><div class="base-card relative" data-entity-urn="urn:li:jobPosting:', JobId,
  '"><a class="base-card" data-entity-urn="urn:li:ad:0">x</a></div></li>',
  '<li><a class="base-card" data-entity-urn="urn:li:jobPosting:9', JobId, '">y</a></li>',
  '<li><p>no card</p></li>') AS html
FROM jobs_raw""",
    # Detail pages: fields that are missing have no element; without a seniority level there is no
    # criteria list at all; the description holds nested blocks.
    "job_pages": """
SELECT JobId, ExtractionDatetime AS fetched, concat(
  '<section><h2 class="top-card-layout__title big">\n  ', JobTitle, '</h2>',
  '<a class="topcard__org-name-link" href="', CompanyLinkedinUrl, '"> ', CompanyName, ' </a>',
  '<span class="topcard__flavor">other</span>',
  '<span class="topcard__flavor topcard__flavor--bullet"> ', Location, '\n</span>',
  CASE WHEN NbrOfApplicants IS NULL THEN '' ELSE
    concat('<span class="num-applicants__caption">', NbrOfApplicants, '</span>') END,
  '<div class="show-more-less-html__markup x"><p>', JobDescription, '</p><div><b>R&amp;D</b>',
  ' and <i>more</i></div></div><div>footer</div>',
  CASE WHEN SeniorityLevel IS NULL THEN '' ELSE concat(
    '<ul class="description__job-criteria-list">',
    '<li><h3>a</h3><span class="description__job-criteria-text x"> ', SeniorityLevel, ' </span></li>',
    '<li><span class="description__job-criteria-text x">', EmploymentType, '</span></li>',
    '<li><span class="description__job-criteria-text x">', JobFunction, '</span></li></ul>') END,
  '</section>') AS html
FROM jobs_raw""",
}

# Oracle-side tables: what the operators should have made of the inputs.
DERIVED = {
    "jobs_clean": """
SELECT TRY_CAST(JobId AS BIGINT) AS JobId, JobTitle, nullif(CompanyName, 'N/A') AS CompanyName,
  nullif(CompanyLinkedinUrl, 'N/A') AS CompanyLinkedinUrl, split_part(Location, ',', 1) AS City,
  TRY_CAST(split_part(NbrOfApplicants, ' ', 1) AS INTEGER) AS NbrOfApplicants, JobDescription,
  SeniorityLevel, EmploymentType, JobFunction, Industries,
  coalesce(TRY_CAST(publishdatetime AS TIMESTAMP), ExtractionDatetime) AS ExtractionDatetime,
  ExtractionDatetime AS SeenAt
FROM jobs_raw""",
    "jobs_silver": """
SELECT * EXCLUDE (rn, SeenAt) FROM (
  SELECT *, row_number() OVER (PARTITION BY JobId ORDER BY SeenAt) AS rn
  FROM jobs_clean WHERE JobId IS NOT NULL) WHERE rn = 1""",
    "population_silver": """
SELECT substring(region, 6) AS City,
  CAST(sum(CASE WHEN sex = 'män' THEN CAST(value AS BIGINT) END) AS INTEGER) AS MenPopulation,
  CAST(sum(CASE WHEN sex = 'kvinnor' THEN CAST(value AS BIGINT) END) AS INTEGER) AS WomenPopulation,
  CAST(sum(CASE WHEN sex = 'män' THEN CAST(value AS BIGINT) END)
     + sum(CASE WHEN sex = 'kvinnor' THEN CAST(value AS BIGINT) END) AS INTEGER) AS TotalPopulation
FROM population_raw WHERE period = '2024M08' AND sex IN ('män', 'kvinnor') GROUP BY region""",
    "followers_silver": """
SELECT url, Nbr_of_followers, extraction_time FROM followers_raw WHERE batch = 2
UNION ALL
SELECT url, Nbr_of_followers, extraction_time FROM followers_raw
WHERE batch = 1 AND Nbr_of_followers IS NOT NULL
  AND url NOT IN (SELECT url FROM followers_raw WHERE batch = 2)""",
    "answers_json": """
SELECT JobId, TRY_CAST(response AS JSON) AS j FROM enrichment_response""",
    "answers": """
SELECT JobId, CASE WHEN j IS NULL THEN 'bad_json' ELSE 'ok' END AS status,
  CASE json_type(j, '$.Tools') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.Tools') AS VARCHAR[])
    WHEN 'VARCHAR' THEN [json_extract_string(j, '$.Tools')] END AS Tools,
  CASE json_type(j, '$.Requirements')
    WHEN 'ARRAY' THEN CAST(json_extract(j, '$.Requirements') AS VARCHAR[])
    WHEN 'VARCHAR' THEN [json_extract_string(j, '$.Requirements')] END AS Requirements,
  CASE json_type(j, '$.Offer') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.Offer') AS VARCHAR[])
    WHEN 'VARCHAR' THEN [json_extract_string(j, '$.Offer')] END AS Offer,
  json_extract_string(j, '$.WorkType') AS WorkType
FROM answers_json""",
    "answers_wide": """
SELECT JobId, status, t AS Tools, r AS Requirements, o AS Offer, WorkType FROM answers
LEFT JOIN LATERAL (SELECT unnest(Tools) AS t) ON true
LEFT JOIN LATERAL (SELECT unnest(Requirements) AS r) ON true
LEFT JOIN LATERAL (SELECT unnest(Offer) AS o) ON true""",
    "answers_long": """
SELECT DISTINCT JobId, 'Tools' AS kind, unnest(Tools) AS value FROM answers
UNION ALL SELECT DISTINCT JobId, 'Requirements', unnest(Requirements) FROM answers
UNION ALL SELECT DISTINCT JobId, 'Offer', unnest(Offer) FROM answers""",
    "enriched": """
SELECT DISTINCT JobId, Tools, Requirements, Offer,
  CASE WHEN WorkType IS NULL OR WorkType = 'Null' THEN 'In-Office' ELSE WorkType END AS WorkType
FROM answers_wide WHERE status = 'ok'""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame; its times have no zone, like those of the tables."""
    text, used = FIXTURES[name], {}
    for t in TABLES:
        if f"{{{t}}}" in text:
            used[t] = table(spark, sf_dir, t)
    for f in FIXTURES:
        if f != name and re.search(rf"FROM {f}\b", text):
            text = re.sub(rf"FROM {f}\b", f"FROM {{{f}}}", text)
            used[f] = fixture(spark, sf_dir, f)
    df = spark.sql(text, **used)
    zoned = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def oracle(sql: str) -> str:
    """The query with the derived tables it needs as common table expressions."""
    known = {n: t.format(**{t: t for t in TABLES}) for n, t in FIXTURES.items()} | DERIVED
    order: list[str] = []

    def need(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(known[name])
                order.append(name)

    need(sql)
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in order)
    return f"WITH {ctes}\n{sql.strip()}" if ctes else sql.strip()
