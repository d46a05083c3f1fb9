"""The operators over the driver's tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.collocations import collocations
from jobmart.llm.common import documents, prepare
from jobmart.llm.decontaminate import leaks
from jobmart.llm.exact_dedup import exact_groups
from jobmart.llm.html_crf import fit, main_text
from jobmart.llm.langid import language_of, profiles
from jobmart.llm.license_scan import licenses
from jobmart.llm.near_dedup import near_groups
from jobmart.llm.packing import pack_documents
from jobmart.llm.resampling import importance
from jobmart.llm.suffix_tree import score_texts
from jobmart.llm.token_store import read_store, write_store
from jobmart.llm.toxicity import fit as fit_toxicity
from jobmart.llm.toxicity import toxicity_of
from jobmart.llm.url_rules import judged, rule_table, rules_of
from jobmart.llm.vocabularies import PACKING_ENCODING, SEQUENCE_TOKENS, STORE_ENCODING
from jobmart.session import work_dir


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), hash_all=True).drop("row")


def in_fold(folds: int) -> Column:
    """Whether the remainder of crc32(doc_id as text) by ``folds`` is 2: rows held out from learning.

    A row without an id is not held out, and nothing is learned from it.
    """
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 2, F.lit(False))


def to_learn(folds: int) -> Column:
    return F.col("doc_id").isNotNull() & ~in_fold(folds)


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    predicted = language_of(spark, profiles(docs.where(to_learn(4))))(F.col("text"))
    return docs.select("doc_id", in_fold(4).alias("held_out"), predicted.alias("found")) \
        .select("doc_id", "held_out", "found.lang_pred", "found.score")


def suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("learn", to_learn(7))
    return score_texts(docs, "doc_id", "text", "learn").withColumn("held_out", in_fold(7))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), size=4).drop("row")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    learn = docs.where(to_learn(4))
    index = fit_toxicity(labels, texts=learn)
    found = docs.select("doc_id", in_fold(4).alias("held_out"), toxicity_of(spark, index)(F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.score", "found.evidence") \
        .withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("row")


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    extract = main_text(spark, fit(pages))
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")) \
        .withColumn("n_chars", F.char_length("text").cast("long"))


def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-store")
    write_store(documents(spark, sf_dir), path, STORE_ENCODING)
    return read_store(spark, path, with_ids=False).drop("ids")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), PACKING_ENCODING, SEQUENCE_TOKENS)


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("row", "n_words")


#: Site rules: an action, and a host with the beginning of a path.
SITES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    urls = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(urls, rule_table(spark, rules_of(SITES))).drop("url")


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id,
    "op2_exact_dedup": exact_dedup,
    "op3_token_store": token_store,
    "op4_near_dedup": near_dedup,
    "op5_packing": packing,
    "op6_decontamination": decontamination,
    "op7_suffix_tree": suffix_tree,
    "op8_toxicity": toxicity,
    "op9_license_scan": license_scan,
    "op10_html_text": html_text,
    "op11_importance_resampling": importance_resampling,
    "op12_url_rules": url_rules,
    "op13_collocations": phrases,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _pattern_sql() -> str:
    """The text of the pattern that decides: one that allows before one that blocks, then the longer, then the smaller."""
    rules = [r for r in rules_of([]) if not r.site]
    rules.sort(key=lambda r: (r.action == "block", -len(r.text), r.text))
    return "CASE " + " ".join(f"WHEN regexp_matches(host || path, '{r.regex}') THEN '{r.text}'" for r in rules) + " END"


def _action_sql(column: str) -> str:
    blocked = ", ".join(f"'{r.text}'" for r in rules_of([]) if r.action == "block")
    return f"{column} IN ({blocked})"


_SITES_SQL = ", ".join("('{}', '{}', '{}', '/{}')".format(action, rule, *rule.split("/", 1)) for action, rule in SITES)

ORACLES = {
    "op11_importance_resampling": f"""
        WITH table_of AS (
            SELECT list(list_reduce(list_concat([b], range(8)),
                        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS crc
            FROM range(256) r(b)),
        texts AS (
            SELECT row_number() OVER () AS place, doc_id, text, true AS corpus FROM documents
            UNION ALL SELECT NULL, NULL, text, false FROM benchmark),
        words AS (
            SELECT place, doc_id, corpus, unnest(list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")},
                   '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')) AS word
            FROM texts),
        spelled AS (
            SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM words)),
        buckets AS (
            SELECT word, xor(4294967295, list_reduce(list_concat([4294967295],
                   list_transform(range(length(code) // 2), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT)),
                   lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
            FROM spelled, table_of),
        found AS (SELECT words.*, bucket FROM words JOIN buckets USING (word)),
        counts AS (
            SELECT bucket, count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t FROM found GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts)::DOUBLE + 10000)
                   / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts)::DOUBLE + 10000))))::BIGINT AS gain
            FROM counts),
        weights AS (
            SELECT place, count(*) AS n_features, sum(gain)::BIGINT AS weight
            FROM found JOIN gains USING (bucket) WHERE corpus GROUP BY place),
        scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                       + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (place) WHERE corpus),
        ordered AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
        FROM ordered""",
    "op12_url_rules": f"""
        WITH parts AS (
            SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        rules(action, rule, rule_host, rule_path) AS (VALUES {_SITES_SQL}),
        sites AS (
            SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
            FROM (SELECT DISTINCT host, path FROM parts) p
            JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY host, path),
        decided AS (
            SELECT page_id, host, path, rule, action,
                   CASE WHEN rule IS NULL THEN {_pattern_sql()} END AS pattern
            FROM parts LEFT JOIN sites USING (host, path))
        SELECT page_id, host, path, rule, pattern,
               CASE WHEN rule IS NOT NULL THEN action WHEN {_action_sql("pattern")} THEN 'block' ELSE 'allow' END AS verdict
        FROM decided""",
    "op13_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")},
                   '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        sequences AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]'), lambda w: w <> '') AS words FROM pieces),
        runs AS (
            SELECT lang, k, words, unnest(range(1, length(words) - k + 2)) AS i
            FROM sequences, range(1, 5) r(k) WHERE length(words) >= k),
        counts AS (SELECT lang, words[i:i + k - 1] AS phrase, count(*) AS a FROM runs GROUP BY ALL),
        sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE length(phrase) = 1 GROUP BY lang),
        candidates AS (SELECT * FROM counts WHERE length(phrase) > 1 AND a >= 30),
        inner_parts AS (
            SELECT lang, phrase[i:i + k - 1] AS phrase, max(a) AS around
            FROM (SELECT lang, phrase, a, k, unnest(range(1, length(phrase) - k + 2)) AS i
                  FROM candidates, range(2, 4) r(k) WHERE length(phrase) > k)
            GROUP BY ALL),
        kept AS (
            SELECT c.* FROM candidates c LEFT JOIN inner_parts p USING (lang, phrase)
            WHERE around IS NULL OR 100 * around < 80 * a),
        cuts AS (SELECT lang, phrase, a, unnest(range(1, length(phrase))) AS k FROM kept),
        valued AS (
            SELECT cuts.lang, cuts.phrase, cuts.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * cuts.a // (l.a + r.a))::BIGINT AS score
            FROM cuts JOIN counts l ON l.lang = cuts.lang AND l.phrase = cuts.phrase[1:k]
            JOIN counts r ON r.lang = cuts.lang AND r.phrase = cuts.phrase[k + 1:]),
        lowest AS (
            SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER best AS rank, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
        FROM lowest JOIN sizes USING (lang)
        WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' '))
        QUALIFY rank <= 2000""",
    "op2_exact_dedup": """
        WITH shaped AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER best AS kept, text_sha256
        FROM shaped
        WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)""",
}
