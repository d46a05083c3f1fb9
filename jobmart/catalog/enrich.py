"""Enrichment: backlog, merges, model answers, lexicon."""

from __future__ import annotations

from threading import get_ident

from pyspark.sql import functions as F

from jobmart.catalog.registry import Inputs, query
from jobmart.functions import cleaning
from jobmart.operators import enrichment, merge
from jobmart.plans import jobs_flow
from jobmart.schemas import ENRICHED
from jobmart.sources import readers, tables

# Word list for offline matching; the words occur in the test prose.
LEXICON = {
    "Tools": ["ther", "tion"],
    "Requirements": ["that", "with"],
    "Offer": ["license"],
    "Remote": ["from"],
    "Hybrid": ["und", "avec"],
}


# --- backlog, insert-only merge, orphans ------------------------------------------------------


@query("enrich_backlog", """
SELECT JobId, JobDescription FROM job_descriptions
WHERE JobId NOT IN (SELECT JobId FROM enriched_seed)""")
def enrich_backlog(src: Inputs):
    return jobs_flow.backlog(src.fixture("job_descriptions"), src.fixture("enriched_seed"))


@query("enrich_backlog_first_run", "SELECT JobId, JobDescription FROM job_descriptions")
def enrich_backlog_first_run(src: Inputs):
    done = readers.table_or_empty(src.spark, "enriched_job_of_no_run_yet", ENRICHED)
    return jobs_flow.backlog(src.fixture("job_descriptions"), done)


_NOT_IN_LEFT = "SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE doc_id END AS k FROM documents"


@query("not_in_null_aware", f"""
SELECT 'plain' AS list, doc_id FROM ({_NOT_IN_LEFT})
WHERE k NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT 'null', doc_id FROM ({_NOT_IN_LEFT})
WHERE k NOT IN (SELECT CASE WHEN toxic = 1 THEN NULL ELSE doc_id END FROM labels)
UNION ALL
SELECT 'empty', doc_id FROM ({_NOT_IN_LEFT})
WHERE k NOT IN (SELECT doc_id FROM labels WHERE quality > 9)""")
def not_in_null_aware(src: Inputs):
    left = src.table("documents").select(
        "doc_id", F.when(F.col("lang") != "de", F.col("doc_id")).alias("k")
    )
    labels = src.table("labels")
    lists = {
        "plain": labels.select(F.col("doc_id").alias("v")),
        "null": labels.select(F.when(F.col("toxic") != 1, F.col("doc_id")).alias("v")),
        "empty": labels.filter("quality > 9").select(F.col("doc_id").alias("v")),
    }
    plain, *rest = (
        merge.not_in(left, "k", values, "v").select(F.lit(name).alias("list"), "doc_id")
        for name, values in lists.items()
    )
    for other in rest:
        plain = plain.unionByName(other)
    return plain


@query("orphan_ids", """
SELECT DISTINCT JobId FROM enriched_seed WHERE JobId NOT IN (SELECT JobId FROM job_descriptions)""")
def orphan_ids(src: Inputs):
    return merge.orphan_keys(
        src.fixture("enriched_seed"), src.fixture("job_descriptions"), ["JobId"]
    )


@query("orphan_prune", """
SELECT JobId, Tools, Requirements, Offer, WorkType FROM enriched_seed
WHERE JobId IN (SELECT JobId FROM job_descriptions)""")
def orphan_prune(src: Inputs):
    return merge.prune_orphans(
        src.fixture("enriched_seed"), src.fixture("job_descriptions"), ["JobId"]
    )


_INSERTED = """
SELECT JobId, Tools, Requirements, Offer, WorkType FROM enriched_seed
UNION ALL
SELECT JobId, Tools, Requirements, Offer, WorkType FROM enriched
WHERE JobId NOT IN (SELECT JobId FROM enriched_seed)"""


@query("enriched_insert_only", _INSERTED)
def enriched_insert_only(src: Inputs):
    rows = enrichment.to_wide(enrichment.parse_answers(src.fixture("enrichment_response")))
    return merge.insert_only(src.fixture("enriched_seed"), rows, ["JobId"])


@query("enriched_after_run", f"""
SELECT * FROM ({_INSERTED}) WHERE JobId IN (SELECT JobId FROM job_descriptions)""")
def enriched_after_run(src: Inputs):
    return jobs_flow.enriched_after(
        src.fixture("enriched_seed"), src.fixture("enrichment_response"),
        src.fixture("job_descriptions"), wide=True,
    )


# --- answers ----------------------------------------------------------------------------------


def _answers(src: Inputs):
    return enrichment.parse_answers(src.fixture("enrichment_response"))


@query("enrichment_parse", """
SELECT JobId, array_to_string(Tools, '|') AS Tools, array_to_string(Requirements, '|') AS Requirements,
  array_to_string(Offer, '|') AS Offer, WorkType, status FROM answers""")
def enrichment_parse(src: Inputs):
    return _answers(src).withColumns(
        {n: F.array_join(n, "|") for n in enrichment.LISTS}
    )


@query("enrichment_scalar_as_list", """
SELECT JobId, CAST(len(Tools) AS INTEGER) AS tools, Tools[1] AS first_tool FROM answers
WHERE Tools IS NOT NULL""")
def enrichment_scalar_as_list(src: Inputs):
    answers = _answers(src).filter(F.col("Tools").isNotNull())
    return answers.select(
        "JobId", F.size("Tools").alias("tools"), F.get("Tools", F.lit(0)).alias("first_tool")
    )


@query("enrichment_unknown_keys", """
SELECT * FROM (WITH entries AS (
  SELECT j, unnest(json_keys(j)) AS key FROM answers_json WHERE json_type(j) = 'OBJECT'),
typed AS (
  SELECT key, json_type(j, concat('$."', key, '"')) AS t FROM entries
  WHERE key NOT IN ('Tools', 'Requirements', 'Offer', 'WorkType'))
SELECT key, CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean'
  WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS type, count(*) AS n
FROM typed GROUP BY ALL)""")
def enrichment_unknown_keys(src: Inputs):
    return enrichment.unknown_keys(src.fixture("enrichment_response"))


@query("enrichment_explode_wide", """
SELECT JobId, Tools, Requirements, Offer, WorkType, status FROM answers_wide""")
def enrichment_explode_wide(src: Inputs):
    return enrichment.explode_wide(_answers(src))


@query("enrichment_explode_long", "SELECT JobId, kind, value FROM answers_long")
def enrichment_explode_long(src: Inputs):
    return enrichment.explode_long(_answers(src))


@query("worktype_default", """
SELECT JobId, CASE WHEN WorkType IS NULL OR WorkType = 'Null' THEN 'In-Office' ELSE WorkType END
  AS WorkType FROM answers""")
def worktype_default(src: Inputs):
    return _answers(src).select(
        "JobId", cleaning.work_type_or_default(F.col("WorkType")).alias("WorkType")
    )


@query("worktype_domain_violations", """
SELECT JobId, WorkType FROM answers
WHERE WorkType NOT IN ('Remote', 'Hybrid', 'In-Office', 'Null')""")
def worktype_domain_violations(src: Inputs):
    return enrichment.work_type_violations(_answers(src)).select("JobId", "WorkType")


# --- lexicon ----------------------------------------------------------------------------------

_TOKENS = r"""
  SELECT JobId, list_distinct(string_split_regex(lower(JobDescription), '[\s,.;:!?()|]+')) AS t
  FROM job_descriptions"""


def _hits(kind: str) -> str:
    words = ", ".join(f"'{w}'" for w in LEXICON[kind])
    return f"list_sort(list_intersect(t, [{words}]))"


@query("enrich_lexicon", f"""
SELECT JobId, array_to_string({_hits("Tools")}, ',') AS Tools,
  array_to_string({_hits("Requirements")}, ',') AS Requirements,
  array_to_string({_hits("Offer")}, ',') AS Offer,
  CASE WHEN len({_hits("Remote")}) > 0 THEN 'Remote' WHEN len({_hits("Hybrid")}) > 0 THEN 'Hybrid'
    END AS WorkType
FROM ({_TOKENS})""")
def enrich_lexicon(src: Inputs):
    found = enrichment.match_lexicon(src.fixture("job_descriptions"), LEXICON)
    return found.withColumns(
        {n: F.array_join(F.array_sort(n), ",") for n in enrichment.LISTS}
    )


# A lexicon that grows with the data: the words of page navigation, by page language.
_NAV_LEXICON = """
  SELECT DISTINCT regexp_extract(html, '<html lang="([a-z]+)"', 1) AS kind,
    lower(unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1))) AS token
  FROM pages"""


@query("enrich_lexicon_table", f"""
SELECT JobId, kind, value FROM (
  SELECT JobId, unnest(t) AS value FROM ({_TOKENS})) JOIN ({_NAV_LEXICON}) ON value = token""")
def enrich_lexicon_table(src: Inputs):
    html = F.col("html")
    words = F.regexp_extract_all(html, F.lit('<li><a href="[^"]*">([^<]*)</a>'), F.lit(1))
    lexicon = src.table("pages").select(
        F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("kind"), F.explode(words).alias("w")
    ).select("kind", F.lower("w").alias("token"))
    return enrichment.match_lexicon_table(src.fixture("job_descriptions"), lexicon)


# The first words of each benchmark text and, as other kinds, shorter beginnings of some of them.
_PHRASES = """
  SELECT 'Tools' AS kind, array_to_string((string_split_regex(lower(text), '[\\s,.;:!?()|]+'))[1:4], ' ') AS phrase FROM benchmark
  UNION ALL
  SELECT CASE WHEN item_id % 2 = 0 THEN 'Offer' ELSE 'Requirements' END,
    array_to_string((string_split_regex(lower(text), '[\\s,.;:!?()|]+'))[1:1 + item_id % 3], ' ') FROM benchmark"""


@query("enrich_lexicon_phrases", f"""
SELECT * FROM (WITH RECURSIVE listed AS MATERIALIZED (
  SELECT DISTINCT kind, list_filter(string_split(phrase, ' '), lambda w: w <> '') AS w FROM ({_PHRASES})),
texts AS MATERIALIZED (
  SELECT JobId, list_filter(string_split_regex(lower(JobDescription), '[\\s,.;:!?()|]+'), lambda w: w <> '') AS w
  FROM job_descriptions),
places AS (SELECT JobId, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
found AS MATERIALIZED (
  SELECT JobId, i, max(len(l.w)) AS n FROM places p JOIN (SELECT DISTINCT w FROM listed WHERE len(w) > 0) l
  ON p.w[i] = l.w[1] AND p.w[i:i + len(l.w) - 1] = l.w GROUP BY ALL),
taken AS (
  SELECT JobId, min(i) AS i, arg_min(n, i) AS n FROM found GROUP BY JobId
  UNION ALL
  SELECT t.JobId, f.i, f.n FROM taken t, LATERAL (
    SELECT min(g.i) AS i, arg_min(g.n, g.i) AS n FROM found g WHERE g.JobId = t.JobId AND g.i >= t.i + t.n) f
  WHERE f.i IS NOT NULL)
SELECT t.JobId, CAST(i - 1 AS INTEGER) AS first_word, CAST(n AS INTEGER) AS n_words, array_to_string(x.w[i:i + n - 1], ' ') AS phrase, kind
FROM taken t JOIN texts x USING (JobId) JOIN listed l ON l.w = x.w[i:i + n - 1])""")
def enrich_lexicon_phrases(src: Inputs):
    words = enrichment.words(F.col("text"))
    items = src.table("benchmark")
    shorter = F.when(F.col("item_id") % 2 == 0, "Offer").otherwise("Requirements")
    phrases = items.select(F.lit("Tools").alias("kind"), F.array_join(F.slice(words, 1, 4), " ").alias("phrase")).unionByName(
        items.select(shorter.alias("kind"), F.array_join(F.slice(words, 1, (F.col("item_id") % 3 + 1).cast("int")), " ").alias("phrase")))
    return enrichment.match_phrases(src.fixture("job_descriptions"), phrases)


# --- model calls ------------------------------------------------------------------------------


def stand_in_model():
    """A stand-in for a model client: refuses some texts and is busy once for others, for each call anew.

    A call's tries stay in one thread, so what a thread was told last belongs to its own call.
    """
    told_to_wait = {}

    def ask(text: str) -> str:
        if len(text) % 7 == 0:
            raise ValueError("content rejected")
        if len(text) % 5 == 0 and told_to_wait.pop(get_ident(), None) != text:
            told_to_wait[get_ident()] = text
            raise RuntimeError("error 429: retry after 0 seconds")
        return f'{{"Tools":["words{len(text.split(" "))}"],"WorkType":"Remote"}}'

    return ask


_CALLED = """
SELECT JobId, CASE WHEN length(JobDescription) % 7 <> 0 THEN concat('{"Tools":["words',
    len(string_split(JobDescription, ' ')), '"],"WorkType":"Remote"}') END AS response,
  CASE WHEN length(JobDescription) % 7 = 0 THEN 'failed' ELSE 'ok' END AS status,
  CAST(CASE WHEN length(JobDescription) % 7 <> 0 AND length(JobDescription) % 5 = 0 THEN 2 ELSE 1 END
    AS INTEGER) AS attempts,
  CASE WHEN length(JobDescription) % 7 = 0 THEN 'content rejected' END AS error
FROM job_descriptions WHERE JobId NOT IN (SELECT JobId FROM enriched_seed)"""


def _called(src: Inputs):
    todo = jobs_flow.backlog(src.fixture("job_descriptions"), src.fixture("enriched_seed"))
    return enrichment.call_model(todo, stand_in_model())


@query("enrich_map_partitions", _CALLED)
def enrich_map_partitions(src: Inputs):
    return _called(src)


@query("enrich_equal_texts_once", _CALLED)
def enrich_equal_texts_once(src: Inputs):
    todo = jobs_flow.backlog(src.fixture("job_descriptions"), src.fixture("enriched_seed"))
    return enrichment.call_model_once(todo, stand_in_model())


@query("enrich_dead_letter", f"SELECT JobId, attempts, error FROM ({_CALLED}) WHERE status <> 'ok'")
def enrich_dead_letter(src: Inputs):
    answers = tables.land(_called(src), src.work_dir("answers"))
    return enrichment.dead_letters(answers).select("JobId", "attempts", "error")
