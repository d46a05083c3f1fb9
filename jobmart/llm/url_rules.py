"""URL rules, indexed by their rarest literal token.

A rule is a pattern on ``host + path``, written as filter lists write it: ``||`` at the start anchors it to
the host or one of its parent domains, ``*`` stands for any characters, ``^`` for a character other than a
letter or digit or for the end, ``|`` at an end anchors it there, everything else stands for itself. A token is a
run of ASCII letters and digits. The tokens of a rule that are whole in every address it fits are its
literal tokens; of these it is indexed by the one that fewest addresses hold. The tokens of an address
fetch the rules indexed by them, and only those run their regular expression.

Rules of two kinds decide: site rules (host, path), the longest of which wins, and where none fits,
patterns, of which those that allow go before those that block. What no rule fits is allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import same, written

#: What the method judges by where no site rule fits: addresses of advertising, of offers in bulk, and of
#: pages that hold no text of their own.
PATTERNS = [
    ("block", "||ads-track."), ("block", ".ads-track."), ("block", "-track.*/pixel"), ("block", "/adserver^"),
    ("block", "cheap-pills."), ("block", "-casino."), ("block", "/casino-bonus^"), ("block", "free-followers."),
    ("block", "/login^"), ("block", "/signup^"), ("block", "/cart^"), ("block", "/wp-admin^"), ("block", "/tag/*/page/"),
    ("block", "/search^"), ("block", "/print/"), ("block", "/feed/|"),
    ("allow", "||arxiv.org/"), ("allow", "/robots.txt|"), ("allow", "/login/help/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TOKEN = r"[0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    action: str
    text: str
    regex: str
    tokens: tuple[str, ...]
    #: Site rules go before patterns, longer ones before shorter ones.
    site: bool = False


def _rule(action: str, text: str, pattern: str, site: bool) -> Rule:
    body, host = (pattern[2:], True) if pattern.startswith("||") else (pattern, False)
    start = not host and body.startswith("|")
    body = body[start:]
    end = body.endswith("|")
    body = body.removesuffix("|")
    parts = {"*": ".*", "^": "(?:[^0-9A-Za-z]|$)"}
    regex = "".join(parts.get(c) or (c if re.fullmatch(r"[\w/-]", c, re.ASCII) else f"\\x{{{ord(c):X}}}") for c in body)
    regex = "(?s)" + ("^(?:[^/]*[.])?" if host else "^" if start else "") + regex + ("$" if end else "")
    # A token is whole if a literal that is no part of a token, or an anchor, stands on both of its sides.
    closed = ("|" if host or start else "*") + body + ("|" if end else "*")
    tokens = [m[0] for m in re.finditer(_TOKEN, closed) if closed[m.start() - 1] != "*" and closed[m.end()] != "*"]
    return Rule(action, text, regex, tuple(dict.fromkeys(tokens)), site)


def site_rule(action: str, rule: str) -> Rule:
    """A rule ``host/path``: it fits the host and its subdomains where the path starts with the rule's."""
    host, slash, path = rule.partition("/")
    plain = (host.translate(str.maketrans(_UPPER, _LOWER)) + slash + path)
    if set("*^|") & set(plain):
        raise ValueError(f"a site rule has no wildcards: {rule}")
    return _rule(action, rule, f"||{plain}", True)


def pattern_rule(action: str, pattern: str) -> Rule:
    return _rule(action, pattern, pattern, False)


def rules_of(sites: Iterable[tuple[str, str]], patterns: Iterable[tuple[str, str]] = PATTERNS) -> list[Rule]:
    return [site_rule(*s) for s in sites] + [pattern_rule(*p) for p in patterns]


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame(
        [(r.site, r.action, r.text, r.regex, list(r.tokens)) for r in rules],
        "site boolean, action string, rule string, regex string, tokens array<string>",
    )


def indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rules`` with ``token``: of their tokens the one with the fewest rows in ``tokens``, ties to the smaller.

    A rule without a literal token is indexed by the empty one, which every address has.
    """
    own = rules.select("rule", "site", F.explode("tokens").alias("token"))
    counts = tokens.join(own.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rare = own.join(counts, "token", "left").groupBy("rule", "site") \
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("_best"))
    return rules.join(rare, ["rule", "site"], "left").withColumn("token", F.coalesce("_best.token", F.lit(""))).drop("_best", "tokens")


def judged(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule, pattern and verdict.

    ``rule`` is the site rule that decides, ``pattern`` the pattern that does where no site rule fits, else
    NULL. Of equally long fitting rules the one that blocks wins, then the smaller text. NULL urls and those
    without ``://`` have empty hosts and paths, which only a pattern can fit. Every row is returned, repeated ones too;
    columns of these names in ``urls`` are replaced. Addresses of many rows are judged once.
    """
    rows = urls.drop("host", "path", "rule", "pattern", "verdict") \
        .withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    address = F.concat("host", "path")
    tokens = rows.select("host", "path", F.explode(F.array_union(
        F.regexp_extract_all(address, F.lit(f"({_TOKEN})"), 1), F.array(F.lit("")))).alias("token"))
    index = written(indexed(rules, tokens.select("token")), "url-rules")
    fitting = tokens.join(index, "token").where(F.rlike(address, F.col("regex")))
    # Site rules first; then the longer one, of patterns one that allows; then one that blocks, then the smaller text.
    order = F.struct(
        (~F.col("site")).alias("kind"), (~F.col("site") & (F.col("action") == "block")).alias("block"),
        (-F.length("rule")).alias("short"), (F.col("action") == "allow").alias("allow"), "rule", "action",
    )
    best = fitting.groupBy("host", "path").agg(F.min(order).alias("_best")) \
        .select(F.col("host").alias("_host"), F.col("path").alias("_path"), "_best")
    on = same(rows["host"], best["_host"]) & same(rows["path"], best["_path"])
    return rows.join(best, on, "left").drop("_host", "_path") \
        .withColumns({
            "rule": F.when(~F.col("_best.kind"), F.col("_best.rule")), "pattern": F.when(F.col("_best.kind"), F.col("_best.rule")),
            "verdict": F.coalesce("_best.action", F.lit("allow")),
        }).drop("_best")


def allowed(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of ``urls`` that no rule blocks, with their columns as they are."""
    kept = urls.withColumn("_own", F.struct(*(F.col(f"`{c}`") for c in urls.columns)))
    found = judged(kept.select("_own", F.col(url).alias("_url")), rules, "_url")
    return found.where("verdict = 'allow'").select("_own.*")
