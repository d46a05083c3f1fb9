import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm.html_crf import Block, Chain, blocks, fit, main_text, tags, train


def page(k: int) -> str:
    rng = random.Random(k)
    body = "".join(f"<p>Paragraph {i} of page {k} says something, at length.</p>" for i in range(rng.randint(1, 5)))
    return (f"<html><head><title>T{k}</title><script>x='<p>no</p>'</script></head><body><nav><ul><li><a href=/a>Home</a></li>"
            f"<li><a>More {k}</a></li></ul></nav><div class='ad'>Buy {k}.</div><article><h1>Title {k}</h1>{body}</article>"
            f"<footer>&copy; site {k}</footer></body></html>")


@pytest.fixture(scope="module")
def model():
    return train([blocks(page(k)) for k in range(60)])


def text_of(model, html):
    own = blocks(html)
    return " ".join(b.text for b, k in zip(own, model.decode(own)) if k)


def test_blocks():
    got = blocks("<body>a <b>b</b>\n c<p>x&amp;y &nbsp; z<p>q<br>r<!-- <p>no --><script>s</script>t<li>i<li>j</p>&lt;k")
    assert [b.text for b in got] == ["a b c", "x&y z", "q rt", "i", "j", "<k"]
    assert blocks(None) == blocks("") == blocks("<!-- never closed <p>x") == []
    assert [b.text for b in blocks("<p title='a>b'>in</p><p")] == ["in", "<p"]
    assert [b.text for b in blocks("x<script>never closed <p>y")] == ["x"]


def test_forward_backward_and_viterbi_by_enumeration():
    rng = np.random.default_rng(1)
    chain = Chain(move=rng.normal(size=(2, 2)))
    for n in (1, 2, 5):
        scores = rng.normal(size=(n, 2))
        weights = {}
        for labels in itertools.product((0, 1), repeat=n):
            total = sum(scores[t, k] for t, k in enumerate(labels)) + sum(chain.move[a, b] for a, b in zip(labels, labels[1:]))
            weights[labels] = np.exp(total)
        whole = sum(weights.values())
        marginals, moves = chain.marginals(scores)
        for t in range(n):
            assert marginals[t, 1] == pytest.approx(sum(w for k, w in weights.items() if k[t]) / whole)
        assert moves.sum() == pytest.approx(n - 1)
        chain.scores = lambda rows, s=scores: s
        assert tuple(chain.decode([Block("x", ())] * n)) == max(weights, key=weights.get)


def test_unseen_pages(model):
    for k in range(100, 130):
        want = " ".join(b.text for b in blocks(page(k)) if any(t == "article" for t, _ in b.path))
        assert text_of(model, page(k)) == want


def test_kinds_of_furniture(model):
    html = """<body><header><h2>Site name</h2></header><div class="cookie-notice"><p>We use cookies here.</p></div>
        <aside><p>Read also this other long story of ours.</p></aside><article><h1>Head</h1><p>First, the text.</p>
        <ul><li>One point.</li></ul><form><label>Mail</label><button>Send</button></form><div class="advert">Buy it.</div>
        <blockquote><p>Quoted words.</p></blockquote><p>The end.</p></article>
        <section class="comments"><p>I liked this article very much, thanks.</p></section><footer>Imprint</footer>"""
    assert text_of(model, html) == "Head First, the text. One point. Quoted words. The end."


def test_column(spark, model):
    rows = [(1, "u", page(1)), (2, None, None), (None, "u", ""), (1, "u", page(1)), (4, "u", "<p>" * 3000 + "deep" + page(4) * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = pages.select("page_id", main_text(spark, model)(F.col("html")).alias("t")).collect()
    assert [r.page_id for r in got] == [1, 2, None, 1, 4]
    assert got[0].t == got[3].t == text_of(model, page(1)) and got[1].t == got[2].t == ""
    assert got[4].t.count("Title 4") == 300


def test_without_pages(spark):
    model = fit(spark.createDataFrame([], "page_id long, url string, html string"))
    pages = spark.createDataFrame([(1, page(1))], "page_id long, html string")
    assert pages.select(main_text(spark, model)(F.col("html")).alias("t")).first().t == ""


def test_driver_pages(spark):
    import html as entities
    import re

    from jobmart.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op10_html_text"](spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        inner = re.sub(r"</?b>", "", inner)
        assert r.text == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert r.n_chars == len(r.text)


def test_self_closed_icons():
    got = blocks("<p>a <svg class='i'/> b</p><object data=x /><p>c</p><svg><title>t</title><path d=''/><text>no</text></svg><p>d</p>")
    assert [b.text for b in got] == ["a", "b", "c", "d"]


def test_head_without_end_tag():
    for start in ("<head><title>t</title><meta name=a><body>", "<head><title>t</title>", "<html><head><link href=x>\n"):
        assert [b.text for b in blocks(start + "<p>a</p>b")] == ["a", "b"]
    assert [b.text for b in blocks("<head><title>t</title>text")] == ["text"]
    assert [b.text for b in blocks("<head><title>t</title><b>x</b> y")] == ["x y"]


def test_unclosed_button_and_option():
    assert [b.text for b in blocks("<div><button>Send<p>a</p><p>b</p></div>c")] == ["a", "b", "c"]
    assert [b.text for b in blocks("<div><datalist><option>x<option>y<p>a</p></datalist></div>")] == ["a"]


def test_pages_without_landmark_teach_nothing(spark):
    plain = [page(k).replace("<article>", "<div class='entry'>").replace("</article>", "</div>") for k in range(300, 360)]
    some = [blocks(page(k)) for k in range(60)]
    assert (train(some + [blocks(p) for p in plain]).emit == train(some).emit).all()
    # Sorted by site, the layout of the last pages is learned too.
    rows = [(k, page(k)) for k in range(400)] + [(k, page(k).replace("article", "main").replace("<p>", "<p class='late'>")) for k in range(400, 800)]
    table = spark.createDataFrame(rows, "page_id long, html string").coalesce(4)
    assert "named=late" in fit(table).index


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a " * 350_000 + ">", '<a "' * 250_000 + ">", "<a '\"" * 200_000 + " > x", "<!" * 500_000, "<div>" * 200_000, "</p>" * 250_000,
    "<a" * 500_000 + ' "', "<script>" * 125_000, "<!--" * 250_000, '<p x="' * 160_000 + "<b>", "<p>" * 300_000, "<button>" * 120_000, "<" * 1_000_000,
])
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    blocks(page)
    assert time.process_time() - began < 4


def test_unclosed_tags_are_text():
    text = lambda page: [b.text for b in blocks(page)]
    assert text("1 < 2 and <b>3</b> > 2 <p>next") == ["1 < 2 and 3 > 2", "next"]
    assert text("<p>one</p> <a href='x>y") == ["one", "<a href='x>y"]
    assert text("<p title=\"a>b\">one</p><p title='\">'>two</p>") == ["one", "two"]
    assert text("a <!-- b > c") == ["a"] and text("a <b <!-- c") == ["a <b"] and text("<title>x <p>y") == []


def test_same_tags_as_one_regular_expression():
    """The tags of small random pages against the quadratic expression for them."""
    whole = re.compile(
        r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|textarea|title|select)\b[^>]*>.*?(?:</\1\s*>|\Z)"
        r"|<(/?)([a-zA-Z][^\s/>\"']*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
    rng = random.Random(8)
    for _ in range(4000):
        page = "".join(rng.choices(["<", ">", "a", "<p", "/", " ", '"', "'", "=", "<!--", "-->", "<!", "title", "</title>", "x", "<title>"], k=rng.randint(1, 14)))
        want = [(m.start(), m.end(), (m[3] or "").lower(), bool(m[2]), m[4] or "") for m in whole.finditer(page)]
        assert [(g.start, g.end, g.name, g.closing, g.attributes) for g in tags(page)] == want, page
