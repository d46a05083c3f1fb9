"""Enrichment of job descriptions: model answers, lexicon matching, flattening."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions.cleaning import WORK_TYPES, is_known_work_type, strip_space, work_type_or_default

LISTS = ["Tools", "Requirements", "Offer"]
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ANSWER = "Tools STRING, Requirements STRING, Offer STRING, WorkType STRING, _bad STRING"


def parse_answers(df: DataFrame, response: str = "response") -> DataFrame:
    """JSON answers as list columns, ``WorkType`` and ``status`` (``ok`` or ``bad_json``).

    Keys that are not asked for are dropped; a missing key is NULL; a single value where a list is
    due becomes a list of one.
    """
    answer = F.from_json(
        F.col("_text"), _ANSWER, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    )
    parsed = df.withColumn("_text", strip_space(F.col(response))).withColumn("_answer", answer)
    # Nothing but an object may be there: Spark's reader stops at its end and ignores what follows.
    is_object = F.col("_text").startswith("{") & F.col("_text").endswith("}")
    alone = F.size(F.from_json(F.concat(F.lit("["), F.col("_text"), F.lit("]")), "ARRAY<STRING>")) == 1
    ok = F.coalesce(is_object & alone & F.col("_answer._bad").isNull(), F.lit(False))

    def as_list(name: str) -> Column:
        raw = F.col(f"_answer.{name}")
        many = F.when(raw.startswith("["), F.from_json(raw, "ARRAY<STRING>"))
        return F.when(ok & raw.isNotNull(), F.coalesce(many, F.array(raw)))

    return parsed.select(
        *(c for c in df.columns if c != response),
        *(as_list(n).alias(n) for n in LISTS),
        F.when(ok, F.col("_answer.WorkType")).alias("WorkType"),
        F.when(ok, "ok").otherwise("bad_json").alias("status"),
    )


def unknown_keys(df: DataFrame, response: str = "response") -> DataFrame:
    """``(key, type, n)``: keys of the answers that no column takes, with the type of their values and how many there are.

    ``type`` is ``number``, ``string``, ``boolean``, ``array``, ``object`` or ``null``. Answers that are no JSON object have no keys, and
    neither has an object that names one key twice.
    """
    parsed = df.select(F.try_parse_json(strip_space(F.col(response))).alias("_v"))
    # Of another value than an object the rows would be its elements.
    objects = parsed.filter(F.schema_of_variant("_v").startswith("OBJECT"))
    entries = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()).select("key", "value"))
    kind = F.split(F.schema_of_variant("value"), "[<(]").getItem(0)
    named = F.when(kind == "VOID", "null").when(kind.isin("BIGINT", "DOUBLE", "DECIMAL"), "number").otherwise(F.lower(kind))
    unknown = entries.filter(~F.col("key").isin(*LISTS, "WorkType"))
    return unknown.groupBy("key", named.alias("type")).agg(F.count("*").alias("n"))


def explode_wide(parsed: DataFrame) -> DataFrame:
    """Every combination of tool, requirement and offer of a job; an empty list counts as one NULL.

    Kept for users of the combined table. Row counts multiply, so ``explode_long`` is the default.
    """
    for name in LISTS:
        parsed = parsed.withColumn(name, F.explode_outer(name))
    return parsed


def explode_long(parsed: DataFrame, key: str = "JobId") -> DataFrame:
    """``(key, kind, value)``, one row per distinct listed value: grows with the lists, not their product."""
    def tagged(name: str) -> Column:
        values = F.coalesce(F.array_distinct(name), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("kind"), v.alias("value")))

    return parsed.select(key, F.explode(F.concat(*map(tagged, LISTS))).alias("_e")).select(
        key, "_e.kind", "_e.value"
    )


def to_lists(parsed: DataFrame) -> DataFrame:
    """Usable answers with their lists, one row per job; a missing work type is read as on site."""
    return parsed.filter(F.col("status") == "ok").select(
        "JobId", *LISTS, work_type_or_default(F.col("WorkType")).alias("WorkType")
    )


def to_wide(parsed: DataFrame) -> DataFrame:
    """The same in the combined form, distinct."""
    return explode_wide(to_lists(parsed)).distinct()


def work_type_violations(parsed: DataFrame) -> DataFrame:
    """Answers whose work type is none of the agreed words."""
    return parsed.filter(~is_known_work_type(F.col("WorkType")))


#: A job is asked again after 1, 2, 4, … hours; from this many failed runs on only after a week.
PATIENCE = 6


def not_given_up(backlog: DataFrame, failures: DataFrame, as_of: datetime) -> DataFrame:
    """The backlog without jobs whose last failure is too recent."""
    hours = F.when(F.col("attempts") >= PATIENCE, 24 * 7).otherwise(F.pow(F.lit(2), F.col("attempts") - 1)).cast("int")
    again = F.col("last_try") + F.make_interval(hours=hours)
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return backlog.join(failures.filter(again > now).select("JobId"), "JobId", "left_anti")


def failures_after(failures: DataFrame, answers: DataFrame, as_of: datetime) -> DataFrame:
    """Failures after a run's calls ``(JobId, response, status, error)``: counted up, or settled."""
    parsed = parse_answers(answers.select("JobId", "response", F.col("status").alias("call"), "error"))
    failed = parsed.filter(F.col("status") != "ok").select("JobId", F.coalesce("error", F.col("status")).alias("error"))
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    before = failures.select("JobId", "attempts")
    news = failed.join(before, "JobId", "left").select(
        "JobId", (F.coalesce("attempts", F.lit(0)) + 1).cast("int").alias("attempts"), "error", now.alias("last_try")
    )
    return failures.join(answers.select("JobId"), "JobId", "left_anti").unionByName(news)


#: Descriptions that a task holds at once: bounds a worker's memory, whatever the number of rows a task has.
CALLED_ROWS = 200


def call_model(
    backlog: DataFrame,
    ask: Callable[[str], str],
    key: str = "JobId",
    text: str = "JobDescription",
    max_tries: int = 20,
    default_wait: int = 10,
    sleep: Callable[[float], None] = time.sleep,
    partitions: int | None = None,
    in_flight: int = 4,
) -> DataFrame:
    """Send every description to ``ask`` on the executors: ``(key, response, status, attempts, error)``.

    A rate limit (429) is waited out, for the stated time if the message names one; any other error
    ends the row, which comes back with status ``failed`` and is still backlog on the next run.
    Texts are spread over ``partitions`` tasks (by default the session's shuffle partitions), whatever
    their bytes, and a task has ``in_flight`` calls under way. Land the result before using it twice.
    """
    def one(description: str) -> tuple[str | None, str, int, str | None]:
        error = None
        for attempt in range(1, max_tries + 1):
            try:
                return ask(description), "ok", attempt, None
            except Exception as exc:  # the client's error types are not known here
                error = str(exc)
                if "429" not in error:
                    return None, "failed", attempt, error
                stated = re.search(r"retry after (\d+) seconds", error)
                sleep(int(stated.group(1)) if stated else default_wait)
        return None, "failed", max_tries, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                answers = pd.DataFrame(
                    list(pool.map(one, batch[text])), columns=["response", "status", "attempts", "error"]
                )
                answers.insert(0, key, batch[key].to_numpy())
                yield answers

    conf = backlog.sparkSession.conf
    if int(conf.get(_BATCH)) > CALLED_ROWS or int(conf.get(_BATCH)) <= 0:
        conf.set(_BATCH, str(CALLED_ROWS))
    tasks = partitions or int(conf.get("spark.sql.shuffle.partitions"))
    # A stated number is kept by adaptive execution, which would otherwise join tasks by their bytes.
    todo = backlog.select(key, text).repartition(tasks, key)
    key_type = backlog.schema[key].dataType.simpleString()
    return todo.mapInPandas(
        run, f"{key} {key_type}, response STRING, status STRING, attempts INT, error STRING"
    )


def call_model_once(
    backlog: DataFrame, ask: Callable[[str], str], key: str = "JobId", text: str = "JobDescription", **settings
) -> DataFrame:
    """As ``call_model``, but equal descriptions are sent once and each of their rows gets the answer.

    Equal texts are put together before any shuffle, so a description that many jobs share is no large
    group; the rows meet their answer in a plain join, which Spark can split.
    """
    rows = backlog.select(key, text, F.coalesce(F.sha2(F.col(text), 256), F.lit("")).alias("_digest"))
    distinct = rows.groupBy("_digest").agg(F.first(text).alias(text))
    answers = call_model(distinct, ask, "_digest", text, **settings)
    return rows.select(key, "_digest").join(answers, "_digest").drop("_digest")


def dead_letters(answers: DataFrame) -> DataFrame:
    return answers.filter(F.col("status") != "ok")


def words(text: Column) -> Column:
    """Lower-case words of the whole text."""
    return F.split(F.lower(text), r"[\s,.;:!?()|]+")


def match_lexicon(
    df: DataFrame, lexicon: dict[str, list[str]], key: str = "JobId", text: str = "JobDescription"
) -> DataFrame:
    """Which words of a short word list each description holds, and the work type they speak for.

    ``lexicon`` maps a list column or a work type to its words. It is a parameter and travels in the
    plan, so matching is row-local: one pass over the words of a text, no join, no shuffle.
    """
    def literal(items: list[str]) -> Column:
        return F.array(*map(F.lit, items)).cast("array<string>")

    known = literal(sorted({w for listed in lexicon.values() for w in listed}))
    found = df.select(key, F.array_intersect(words(F.col(text)), known).alias("_found"))

    def hits(kind: str) -> Column:
        return F.array_intersect(F.col("_found"), literal(lexicon.get(kind, [])))

    work_type = F.coalesce(*(F.when(F.size(hits(w)) > 0, F.lit(w)) for w in WORK_TYPES))
    return found.select(key, *(hits(n).alias(n) for n in LISTS), work_type.alias("WorkType"))


def phrase_trie(phrases: DataFrame) -> DataFrame:
    """``(prefix, length, longest, kinds)`` of phrases ``(kind, phrase)`` of any number: the token trie as rows.

    ``prefix`` are the first ``length`` words of phrases joined by a space, ``longest`` the most words of one that goes on from
    there, ``kinds`` the kinds of the phrases that end there (empty within phrases).
    """
    listed = phrases.select("kind", F.array_remove(words(F.col("phrase")), "").alias("w")).filter(F.size("w") > 0)
    nodes = listed.select("kind", F.size("w").alias("n"), "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("length"))
    ends = F.when(F.col("length") == F.col("n"), F.col("kind"))
    return nodes.groupBy(F.array_join(F.slice("w", 1, F.col("length")), " ").alias("prefix"), "length") \
        .agg(F.max("n").alias("longest"), F.sort_array(F.collect_set(ends)).alias("kinds"))


def match_phrases(df: DataFrame, phrases: DataFrame, key: str = "JobId", text: str = "JobDescription") -> DataFrame:
    """``(key, first_word, n_words, phrase, kind)``: where phrases ``(kind, phrase)`` stand, a row for each kind of a phrase.

    The longest phrase at a word wins, and then the leftmost of overlapping ones. Only words that begin a phrase
    go on to longer runs, no longer than a phrase from there can be, and all meet the trie in plain joins on the
    run: a first word that most texts hold is split by Spark's skew join. Words count from 0.
    """
    trie = phrase_trie(phrases)
    spoken = df.select(key, F.array_remove(words(F.col(text)), "").alias("_w"))
    begun = spoken.select(key, F.posexplode("_w").alias("first_word", "prefix")) \
        .join(trie.filter("length = 1").select("prefix", "longest"), "prefix").select(key, "first_word", "longest")
    # The runs are cut from the text's words again, which are not carried through the join above.
    runs = spoken.join(begun.groupBy(key).agg(F.collect_list(F.struct("first_word", "longest")).alias("_at")), key) \
        .select(key, "_w", F.explode("_at").alias("_at")) \
        .select(key, "_at.first_word", F.slice("_w", F.col("_at.first_word") + 1, F.col("_at.longest")).alias("_run")) \
        .select(key, "first_word", "_run", F.explode(F.sequence(F.lit(1), F.size("_run"))).alias("n_words")) \
        .select(key, "first_word", "n_words", F.array_join(F.slice("_run", 1, F.col("n_words")), " ").alias("phrase"))
    ends = trie.filter(F.size("kinds") > 0).select(F.col("prefix").alias("phrase"), "kinds")
    longest = runs.join(ends, "phrase").groupBy(key, "first_word") \
        .agg(F.max(F.struct("n_words", "phrase", "kinds")).alias("m")).select(key, F.struct("first_word", "m.*").alias("m"))
    # A text's matches in order; one is taken if it begins after the end of the one taken last.
    start = F.struct(F.lit(0).alias("free"), F.array().cast(
        "array<struct<first_word:int,n_words:int,phrase:string,kinds:array<string>>>").alias("taken"))
    taken = F.aggregate(F.sort_array(F.collect_list("m")), start, lambda so_far, m: F.when(
        m["first_word"] >= so_far["free"], F.struct(
            (m["first_word"] + m["n_words"]).alias("free"), F.concat(so_far["taken"], F.array(m)).alias("taken")),
    ).otherwise(so_far))["taken"]
    return longest.groupBy(key).agg(taken.alias("_taken")).select(key, F.inline("_taken")) \
        .select(key, "first_word", "n_words", "phrase", F.explode("kinds").alias("kind"))


def match_lexicon_table(
    df: DataFrame, lexicon: DataFrame, key: str = "JobId", text: str = "JobDescription"
) -> DataFrame:
    """``(key, kind, value)`` for a lexicon ``(kind, token)`` of any size.

    A common word occurs in most descriptions. Both sides of the join are exchanged on the word alone,
    so Spark's adaptive skew join splits such a word's rows by what it measures.
    """
    spoken = df.select(key, F.explode(F.array_distinct(words(F.col(text)))).alias("token"))
    listed = lexicon.select("kind", "token").distinct()
    return spoken.join(listed, "token").select(key, "kind", F.col("token").alias("value"))
