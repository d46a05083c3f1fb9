"""Operators against plain Python models on random inputs."""

import random
from collections import Counter
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobmart.catalog import ORACLES, QUERIES
from jobmart.functions import html
from jobmart.functions.html import Selector
from jobmart.operators import merge
from tests.oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
key = st.one_of(st.none(), st.integers(0, 6))
pairs = st.lists(st.tuples(key, st.sampled_from("abc")), max_size=12)


def frame(spark, data):
    return spark.createDataFrame(data, "k BIGINT, v STRING")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@few
@given(target=pairs, source=st.dictionaries(st.integers(0, 6), st.sampled_from("xyz")))
def test_upsert(spark, target, source):
    got = bag(merge.upsert(frame(spark, target), frame(spark, list(source.items())), ["k"]))
    kept = [row for row in target if row[0] is None or row[0] not in source]
    assert got == Counter(kept + list(source.items()))


@few
@given(target=pairs, source=pairs)
def test_insert_only(spark, target, source):
    have = {k for k, _ in target if k is not None}
    got = bag(merge.insert_only(frame(spark, target), frame(spark, source), ["k"]))
    assert got == Counter(target + [row for row in source if row[0] not in have])


@few
@given(child=pairs, parent=pairs)
def test_prune_orphans(spark, child, parent):
    alive = {k for k, _ in parent if k is not None}
    got = bag(merge.prune_orphans(frame(spark, child), frame(spark, parent), ["k"]))
    assert got == Counter(row for row in child if row[0] in alive)


class Outermost(HTMLParser):
    """Outermost elements of one tag, by Python's parser."""

    def __init__(self, tag):
        super().__init__(convert_charrefs=False)
        self.tag, self.depth, self.found, self.texts = tag, 0, 0, []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            if self.depth == 0:
                self.texts.append([])
            self.depth += 1

    def handle_endtag(self, tag):
        if tag == self.tag and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if self.depth and data.strip():
            self.texts[-1].append(data.strip())


def random_markup(rng, depth=0):
    parts = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.35 or depth > 4:
            parts.append(rng.choice(["a", " b c ", "\n", "1 = 2", "x's"]))
        else:
            tag = rng.choice(["div", "DIV", "p", "divx", "li"])
            attrs = rng.choice(["", ' class="d"', " id=x", " title='a > b' ", ' data-div="<"'])
            close = "" if rng.random() < 0.05 and tag == "p" else f"</{tag}>"
            parts.append(f"<{tag}{attrs}>{random_markup(rng, depth + 1)}{close}")
    return "".join(parts)


def test_blocks_agree_with_a_parser(spark):
    rng = random.Random(7)
    pages = [random_markup(rng) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(pages)), "i INT, html STRING")
    texts = F.transform(html.blocks(F.col("html"), "div"), lambda b: html.spaced_text(b))
    got = {r.i: r.t for r in df.select("i", texts.alias("t")).collect()}
    for i, page in enumerate(pages):
        parser = Outermost("div")
        parser.feed(page)
        assert got[i] == [" ".join(t) for t in parser.texts], page


def test_block_by_class_agrees_with_depth_counting(spark):
    rng = random.Random(11)
    pages = [
        f'<div>{random_markup(rng)}</div><div class="x want">{random_markup(rng)}</div>'
        f'<div>{random_markup(rng)}</div>' for _ in range(200)
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i INT, html STRING")
    found = html.find_block(F.col("html"), Selector("div", "want"))
    for row in df.select("html", found.alias("b")).collect():
        start = row.html.index('<div class="x want">')
        assert row.html[start:].startswith(row.b[:-6])
        assert row.b.lower().count("<div>") + row.b.lower().count("<div ") == row.b.lower().count("</div>")


@pytest.mark.parametrize("partitions", ["1", "13"])
@pytest.mark.parametrize("key", ["jobs_upsert", "enriched_after_run", "seniority_by_tool", "company_popularity"])
def test_results_do_not_depend_on_partitions(spark, partitions, key):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert difference(QUERIES[key](spark, SF_DIR), connect(SF_DIR), ORACLES[key]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
