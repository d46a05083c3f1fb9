"""Field extraction from HTML text as column expressions.

A ``Selector`` names an element by tag and class. Elements are passed on as HTML text, where the empty
string means that there is none; values read from an absent element are NULL. Extraction runs on
regular expressions inside the JVM; nested blocks (a description with inner ``div``s) are closed by
counting the tag's depth with a fold over its pieces, so whole documents are read and no Python worker
is involved. Repeated groups are possessive: the matcher never recurses over a long text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart.functions.cleaning import last_part, strip_space

# All named entities of the HTML standard. The commonest come first, as they are looked up in order; these
# four are also read without their semicolon.
_COMMON = ["amp", "lt", "gt", "quot", "nbsp", "apos"]
_STANDARD = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
ENTITIES = {name: _STANDARD[name] for name in _COMMON} | _STANDARD
_REFERENCE = (
    r"^(#[0-9]{1,7};|#[xX][0-9a-fA-F]{1,6};|[a-zA-Z][a-zA-Z0-9]{1,31};|(?:amp|lt|gt|quot)(?![a-zA-Z0-9=;]))"
)

# Attributes of a tag, one ``name=`` with its quoted value after the other; a ``>`` in quotes does not
# end the tag.
_SETTING = r"""(?:[^>=]*=\s*(?:"[^"]*"|'[^']*')?+)"""
_ATTRS = rf"{_SETTING}*+[^>=]*"
_QUOTED = r"""("[^"]*"|'[^']*'|[^\s>"']+)"""


def _up_to(name: str) -> str:
    """The part of a tag from its name to the value of its attribute ``name``."""
    wanted = rf"[^>=]*\s(?i:{name})\s*=\s*"
    return rf"(?:(?!{wanted}){_SETTING})*+{wanted}"


_MARK = "\u0000"

# What is not text: comments, scripts, styles, tags.
_MARKUP = rf"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|</?[a-z]{_ATTRS}>"


@dataclass(frozen=True)
class Selector:
    """An element by tag and, if given, class. Several class words mean that exact attribute value."""

    tag: str
    css_class: str | None = None

    @property
    def opening(self) -> str:
        """Regular expression of the opening tag."""
        tag = rf"<(?i:{self.tag})(?=[\s>/])"
        if self.css_class is None:
            return rf"{tag}{_ATTRS}>"
        words = re.escape(self.css_class).replace(r"\ ", " ")
        if " " in self.css_class:
            value = rf"""(?:"{words}"|'{words}')"""
        else:
            value = rf"""(?:"(?:[^">]*\s)?{words}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{words}(?:\s[^'>]*)?')"""
        return rf"{tag}{_up_to('class')}{value}{_ATTRS}>"

    @property
    def element(self) -> str:
        """Regular expression of the element up to its first closing tag."""
        return rf"(?s){self.opening}.*?</(?i:{self.tag})\s*>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _cut(c: Column, pattern: str, keep: str = "") -> Column:
    """``c`` cut at every match; ``keep`` says what of the match opens the next piece.

    Cutting at a mark that HTML forbids is quicker than cutting at the pattern, which would be compiled
    for every row.
    """
    return F.split(F.regexp_replace(c, pattern, _MARK + keep), _MARK)


def find(html: Column, sel: Selector) -> Column:
    """The first matching element, up to its first closing tag."""
    return F.regexp_extract(html, sel.element, 0)


def find_opening(html: Column, sel: Selector) -> Column:
    """The opening tag of the first matching element."""
    return F.regexp_extract(html, sel.opening, 0)


def find_block(html: Column, sel: Selector) -> Column:
    """The first matching element, where the same tag may occur inside it.

    What follows its opening tag is cut at every tag of that name, and a fold counts the pieces until
    the depth is back to nothing. One that is never closed reaches to the end.
    """
    rest = F.regexp_extract(html, rf"(?s){sel.opening}.*", 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("inside"), F.lit(False).alias("closed"))

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.when(piece.startswith("</"), -1).otherwise(1)
        closed = depth == 0
        inside = acc["inside"] + F.when(closed, 0).otherwise(1)
        return F.when(acc["closed"], acc).otherwise(
            F.struct(depth.alias("depth"), inside.alias("inside"), closed.alias("closed"))
        )

    def join(pieces: Column) -> Column:
        inside = F.aggregate(pieces, start, step, lambda acc: acc["inside"])
        return F.concat(F.array_join(F.slice(pieces, F.lit(1), inside), ""), F.lit(f"</{sel.tag}>"))

    return _once(rest, lambda r: F.when(r == "", r).otherwise(_once(_at_tags(r, sel.tag), join)))


def _at_tags(html: Column, tag: str) -> Column:
    """The page cut at every opening and closing tag of a name, without what stands before the first."""
    return _once(
        _cut(html, rf"(?i)</?{tag}(?=[\s>/])", "$0"), lambda p: F.slice(p, F.lit(2), F.size(p))
    )


def blocks(html: Column, tag: str) -> Column:
    """Elements of one tag that do not lie in another of the same tag, in document order."""
    end = F.lit(f"</{tag}>")

    def flat(pieces: Column) -> Column:
        openings = F.filter(pieces, lambda p: ~p.startswith("</"))
        return F.transform(openings, lambda p: F.concat(p, end))

    def nested(pieces: Column) -> Column:
        return F.transform(
            _outermost(pieces),
            lambda s: F.concat(F.array_join(F.slice(pieces, s["start"], s["pieces"]), ""), end),
        )

    def join(pieces: Column) -> Column:
        in_turn = F.transform(pieces, lambda p, i: p.startswith("</") == (i % 2 == 1))
        is_flat = (F.size(pieces) % 2 == 0) & F.forall(in_turn, lambda x: x)
        return F.when(is_flat, flat(pieces)).otherwise(nested(pieces))

    return _once(_at_tags(html, tag), join)


def _outermost(pieces: Column) -> Column:
    """Start and number of pieces of every outermost element, by a fold that keeps the depth."""
    def note(acc: Column, found: Column) -> Column:
        span = F.struct(acc["start"].alias("start"), (acc["n"] - acc["start"]).alias("pieces"))
        return F.when(found, F.array_append(acc["spans"], span)).otherwise(acc["spans"])

    def step(acc: Column, piece: Column) -> Column:
        closing = piece.startswith("</")
        depth = F.when(closing, F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"] + 1)
        start = F.when(~closing & (acc["depth"] == 0), acc["n"]).otherwise(acc["start"])
        return F.struct(
            depth.alias("depth"), (acc["n"] + 1).alias("n"), start.alias("start"),
            note(acc, closing & (acc["depth"] == 1)).alias("spans"),
        )

    begin = F.struct(
        F.lit(0).alias("depth"), F.lit(1).alias("n"), F.lit(0).alias("start"),
        F.array().cast("array<struct<start:int,pieces:int>>").alias("spans"),
    )
    return F.aggregate(pieces, begin, step, lambda acc: note(acc, acc["depth"] > 0))


def find_all(html: Column, sel: Selector) -> Column:
    """All matching elements in document order, each up to its first closing tag."""
    return F.regexp_extract_all(html, F.lit(sel.element), F.lit(0))


def attribute(element: Column, name: str) -> Column:
    """An attribute of the element's opening tag; NULL if it is not set."""
    setting = F.regexp_extract(element, rf"^<[a-zA-Z0-9]+(?=\s){_up_to(name)}{_QUOTED}", 1)
    return _once(setting, lambda v: F.when(v != "", unescape(F.regexp_replace(v, "^[\"']|[\"']$", ""))))


def text(element: Column) -> Column:
    """Text of an element, pieces put together as they are, outer whitespace dropped."""
    return _once(
        element,
        lambda e: F.when(e != "", strip_space(unescape(F.regexp_replace(e, _MARKUP, "")))),
    )


def spaced_text(element: Column) -> Column:
    """Text of an element with every piece stripped and one space between pieces."""
    def read(e: Column) -> Column:
        pieces = F.transform(_cut(e, _MARKUP), lambda p: strip_space(unescape(p)))
        return F.when(e != "", F.array_join(F.filter(pieces, lambda p: p != ""), " "))

    return _once(element, read)


def unescape(c: Column) -> Column:
    """Entities to characters, in one pass over what follows each ``&``."""
    listed = "\u0001".join(f"{k}\u0002{v}" for k, v in ENTITIES.items())
    named = F.str_to_map(F.lit(listed), F.lit("\u0001"), F.lit("\u0002"))

    def char_of(ref: Column) -> Column:
        code = F.when(
            F.rlike(ref, F.lit("^#[xX]")), F.conv(F.substr(ref, F.lit(3)), 16, 10)
        ).otherwise(F.substr(ref, F.lit(2))).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numeric = F.when(
            valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        ).otherwise("\ufffd")
        return F.when(ref.startswith("#"), numeric).otherwise(F.try_element_at(named, ref))

    def replaced(piece: Column) -> Column:
        found = F.regexp_extract(piece, _REFERENCE, 1)
        char = char_of(F.rtrim(found, F.lit(";")))
        rest = F.substr(piece, F.length(found) + 1)
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    def join(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: replaced(p))
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))

    def read(v: Column) -> Column:
        return F.when(F.contains(v, F.lit("&")), _once(F.split(v, "&"), join)).otherwise(v)

    return _once(c, read)


def item_count(html: Column) -> Column:
    """How many list items a result page shows."""
    return F.regexp_count(html, F.lit("<li>"))


def nth(items: Column, index: int) -> Column:
    """Item by position from 0; NULL beyond the end."""
    return F.get(items, F.lit(index))


def card_id(block: Column) -> Column:
    """Job id of one search-result item: last part of the urn of its card, a ``div`` or else an ``a``."""
    def urn(tag: str) -> Column:
        return attribute(find_opening(block, Selector(tag, "base-card")), "data-entity-urn")

    return last_part(F.coalesce(urn("div"), urn("a")))


# Where a job detail page keeps its fields.
TEXT_FIELDS = {
    "JobTitle": Selector("h2", "top-card-layout__title"),
    "CompanyName": Selector("a", "topcard__org-name-link"),
    "Location": Selector("span", "topcard__flavor topcard__flavor--bullet"),
    "TimePosting": Selector("span", "posted-time-ago__text"),
    "NbrOfApplicants": Selector("span", "num-applicants__caption"),
}
COMPANY_LINK = Selector("a", "topcard__org-name-link")
DESCRIPTION = Selector("div", "show-more-less-html__markup")
CRITERIA = Selector("ul", "description__job-criteria-list")
CRITERION = Selector("span", "description__job-criteria-text")
CRITERIA_FIELDS = ["SeniorityLevel", "EmploymentType", "JobFunction", "Industries"]
TEXT_NAMES = [*TEXT_FIELDS, *CRITERIA_FIELDS]
POST = Selector("li", "mb-1")


def job_texts(html: Column) -> Column:
    """Array of the plain text fields of a job detail page, in the order of ``TEXT_NAMES``.

    An absent field is NULL. The pieces are cut out first and cleaned in one go.
    """
    items = blocks(find_block(html, CRITERIA), "li")
    criteria = _once(items, lambda found: F.array(*(nth(found, i) for i in range(len(CRITERIA_FIELDS)))))
    pieces = F.concat(
        F.array(*(find(html, sel) for sel in TEXT_FIELDS.values())),
        F.coalesce(
            F.transform(criteria, lambda item: find(item, CRITERION)),
            F.array_repeat(F.lit(None).cast("string"), len(CRITERIA_FIELDS)),
        ),
    )
    return F.transform(pieces, lambda piece: text(piece))


def post_texts(html: Column) -> Column:
    """First paragraph of every post on a company page."""
    return F.transform(find_all(html, POST), lambda li: text(find(li, Selector("p"))))


def meta_description(html: Column) -> Column:
    """What a page says about itself in its head."""
    named = rf"""<(?i:meta)(?=\s){_up_to('name')}["']description["']{_ATTRS}>"""
    return attribute(F.regexp_extract(html, named, 0), "content")
