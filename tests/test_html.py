"""HTML extraction on hand-written pages."""

import html as stdlib_html

import pytest
from pyspark.sql import functions as F

from jobmart.functions import html
from jobmart.functions.html import Selector
from jobmart.plans import extraction


def read(spark, page, expr):
    df = spark.createDataFrame([(page,)], "html STRING")
    return df.select(expr(F.col("html")).alias("v")).first().v


@pytest.mark.parametrize(
    "page, found",
    [
        ('<p class="a">x</p>', "x"),
        ("<p id=1 class='b a c'> x\n</p>", "x"),
        ('<P CLASS="a">x</P>', "x"),
        ('<p class="ab">no</p><p class="a b">x</p>', "x"),
        ('<p title="1 > 0" class="a">x</p>', "x"),
        ('<p title="class=a" id=\'class="a"\'>no</p><p it\'s class="a">x</p><i it\'s>', "x"),
        ('<p class="a" title="1 > 0">x</p>', "x"),
        ('<pre class="a">no</pre>', None),
        ('<p class="a"></p>', ""),
        ('<p class="a">x <b>y</b><!-- z --><script>w()</script></p>', "x y"),
        ('<p class="A">case counts</p>', None),
        ("<p " + "x=1 " * 20000 + 'class="a">x</p>', "x"),
        ("<p " + "a='b\" " * 20000, None),
        ("", None),
        (None, None),
    ],
)
def test_element_by_class(spark, page, found):
    assert read(spark, page, lambda h: html.text(html.find(h, Selector("p", "a")))) == found


def test_several_class_words_mean_the_exact_value(spark):
    sel = Selector("span", "x y")
    page = '<span class="x">1</span><span class="y x">2</span><span class="x y">3</span>'
    assert read(spark, page, lambda h: html.text(html.find(h, sel))) == "3"


def test_attribute_forms(spark):
    for setting, value in [('href="/a?x=1&amp;y=2"', "/a?x=1&y=2"), ("href='q'", "q"), ("href=u", "u"),
                           ('data-href="n"', None), ('href=""', ""), ('title="x href=no" HREF="y"', "y"),
                           ("disabled href = 'z'", "z")]:
        page = f"<a id=0 {setting}>t</a>"
        got = read(spark, page, lambda h: html.attribute(html.find(h, Selector("a")), "href"))
        assert got == value, setting


def test_nested_block_is_closed_by_depth(spark):
    page = '<div>no</div><div class="d">a<div>b<div>c</div></div> d</div><div>no</div>'
    block = read(spark, page, lambda h: html.find_block(h, Selector("div", "d")))
    assert block == '<div class="d">a<div>b<div>c</div></div> d</div>'
    assert read(spark, page, lambda h: html.spaced_text(html.find_block(h, Selector("div", "d")))) == "a b c d"
    unclosed = '<div class="d">a<div>b</div> c'
    assert read(spark, unclosed, lambda h: html.spaced_text(html.find_block(h, Selector("div", "d")))) == "a b c"
    assert read(spark, "<p>x</p>", lambda h: html.spaced_text(html.find_block(h, Selector("div", "d")))) is None


def test_outermost_items(spark):
    page = "x<li>a<ul><li>b</li></ul>c</li>between<LI class=q>d</LI></li><link><li>e<li>f</li>"
    got = read(spark, page, lambda h: html.blocks(h, "li"))
    assert got == [
        "<li>a<ul><li>b</li></ul>c</li>", "<LI class=q>d</li>", "<li>e<li>f</li></li>"
    ]
    assert read(spark, "no items", lambda h: html.blocks(h, "li")) == []
    assert read(spark, None, lambda h: html.blocks(h, "li")) is None


def test_long_nested_block_is_read_whole(spark):
    inner = "".join(f"<div>w{i}</div>" for i in range(3000))
    text = read(
        spark, f'<div class="d">{inner}</div><div>no</div>',
        lambda h: html.spaced_text(html.find_block(h, Selector("div", "d"))),
    )
    assert text == " ".join(f"w{i}" for i in range(3000))


@pytest.mark.parametrize(
    "text",
    ["R&amp;D", "&amp;lt;", "a &lt; b &gt; c", "&#229;&#xE5;&#x1F600;", "&aring;&ouml;&nbsp;x", "AT&T",
     "a & b", "&", "&&amp;&", "&quot;q&quot; &apos;s&apos;", "&#0;", "&#xD800;", "&#99999999;", "cut &amp",
     "no entities", "&#12", "&lt"],
)
def test_entities_as_a_browser_reads_them(spark, text):
    if text in ("&#12", "&#99999999;"):  # unfinished or out of range: left as written
        assert read(spark, text, html.unescape) == text
    else:
        assert read(spark, text, html.unescape) == stdlib_html.unescape(text)


DETAIL = """
<section><h2 class="top-card-layout__title topcard__title"> Data &amp; <b>AI</b> lead\n</h2>
<a class="topcard__org-name-link" data-x="1" href="https://jobs.example/c/1?trk=a&amp;b=c">\n Acme </a>
<span class="topcard__flavor">no</span><span class="topcard__flavor topcard__flavor--bullet"> Lund, Sk </span>
<span class="posted-time-ago__text x">1 hour ago</span>
<div class="show-more-less-html__markup"><ul><li>One</li><li>Two</li></ul><div>Three</div></div>
<ul class="description__job-criteria-list"><li><h3>Seniority</h3><span class="description__job-criteria-text a">
 Associate </span></li><li><span class="description__job-criteria-text a">Full-time</span></li></ul></section>
"""


def test_job_details(spark):
    pages = spark.createDataFrame([("1", DETAIL), ("2", "<p>gone</p>"), ("3", None)], "JobId STRING, html STRING")
    seen = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    found = {r.JobId: r for r in extraction.job_details(pages, seen).collect()}
    full = found["1"].asDict()
    assert full["JobTitle"] == "Data & AI lead"
    assert (full["CompanyName"], full["CompanyLinkedinUrl"]) == ("Acme", "https://jobs.example/c/1?trk=a&b=c")
    assert (full["Location"], full["TimePosting"], full["NbrOfApplicants"]) == ("Lund, Sk", "1 hour ago", None)
    assert full["JobDescription"] == "One Two Three"
    assert (full["SeniorityLevel"], full["EmploymentType"]) == ("Associate", "Full-time")
    assert (full["JobFunction"], full["Industries"]) == (None, None)
    for job in ("2", "3"):
        empty = found[job].asDict()
        assert {k for k, v in empty.items() if v is not None} == {"JobId", "ExtractionDatetime"}


def test_job_ids(spark):
    page = (
        '<li><div class="base-card x" data-entity-urn="urn:li:jobPosting:11"></div></li>'
        '<li><a class="base-card" data-entity-urn="urn:li:jobPosting:12">t</a></li>'
        '<li><div class="other" data-entity-urn="urn:li:jobPosting:13"></div></li>'
        '<li><div class="base-card" data-entity-urn="urn:li:jobPosting:15"><ul><li><a class="base-card" '
        'data-entity-urn="urn:li:jobPosting:99"></a></li></ul></div></li>'
        '<li><a class="base-card" data-entity-urn="urn:li:ad:0"></a><div class="base-card" '
        'data-entity-urn="urn:li:jobPosting:14"></div></li>'
    )
    pages = spark.createDataFrame([(page,), (page,), (None,), ("",)], "html STRING")
    assert sorted(r.JobId for r in extraction.job_ids(pages).collect()) == ["11", "12", "14", "15"]


def test_company_followers(spark):
    meta = '<meta name="description" content="Acme | 1,234 followers on Site">'
    pages = spark.createDataFrame(
        [
            ("post", f'{meta}<li class="mb-1"><p>x</p></li><li class="mb-1"><p>12,345 followers</p></li>'),
            ("meta", meta),
            ("words", f'{meta}<li class="mb-1"><p>no number</p></li>'),
            ("none", "<li class='mb-1'><p>x</p></li>"),
        ],
        "url STRING, html STRING",
    )
    seen = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    got = {r.url: r.Nbr_of_followers for r in extraction.company_followers(pages, seen).collect()}
    assert got == {"post": 12345, "meta": 1234, "words": 1234}


def test_all_standard_entities(spark):
    written = "&rarr; &reg; &oslash; &agrave; &equals; &frac12; &NotEqualTilde; &nosuch; &copy 2020 a&b; R&D"
    read = spark.range(1).select(html.unescape(F.lit(written))).first()[0]
    assert read == "→ ® ø à = ½ ≂̸ &nosuch; &copy 2020 a&b; R&D"
