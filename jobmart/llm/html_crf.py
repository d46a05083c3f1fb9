"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between the tags of block elements, each with the elements
that enclose it. Features of a block (ancestor tags, words of their class, id and role, shape of the
text) feed a chain with two labels, article and other; the model is trained by gradient ascent on the
conditional likelihood and pages are decoded by Viterbi.

Training pages are labelled by their own semantic elements: a block inside ``article`` or ``main`` and in
no other landmark is article text. A bounded sample of the pages is used, together with variants of
them in which blocks are wrapped or joined by kinds of page furniture that a sample may lack.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import prepare

#: The model is fitted on this many pages at most, and on this many blocks of each.
SAMPLE_PAGES, SAMPLE_BLOCKS = 120, 200

EPOCHS, RATE, PENALTY = 12, 0.3, 1e-4

#: Fixed values of the HTML standard: elements within a line of text, without content, with raw content.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title select option".split())
HIDDEN = frozenset("script style noscript template svg iframe object head title textarea select option button".split())

#: What a head may hold; anything else, text too, ends it if its end tag is left out.
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template".split())

#: An opening tag of these closes an open element of the same kind (its end tag may be left out).
SELF_CLOSING = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"},
}
#: Block elements, whose opening also ends a paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)

#: Hold no blocks: the next block ends them if their end tag is left out.
NO_BLOCKS = frozenset("button option".split())

#: The beginning of a comment, a declaration or a tag; longer names go on among the attributes.
_OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>\"']{0,63}))")
_MARK = re.compile("[>\"']")
_RAW_NAME = re.compile(r"(?:script|style|noscript|template|iframe|textarea|title|select)\b", re.I)

#: Deeper elements are read as if they ended where they begin, as browsers do.
DEEPEST = 512


@dataclass
class Tag:
    """A tag, or (without a name) a comment, declaration or element with raw content."""

    start: int
    end: int
    name: str = ""
    closing: bool = False
    attributes: str = ""


def tags(page: str) -> Iterator[Tag]:
    """All tags in order, in time that grows with the page alone.

    A tag ends at the next ``>`` outside quotes; a ``<`` without one is text. Where a search for the end has
    failed is remembered by the quotes it met outside of others, as any later search that meets one fails too.
    """
    last, at = page.rfind(">"), 0
    dead: set[int] = set()
    looked_from = mark_at = -1

    def end_of(place: int) -> int | None:
        nonlocal looked_from, mark_at
        met = []
        while True:
            if not looked_from <= place <= mark_at:
                mark = _MARK.search(page, place)
                looked_from, mark_at = place, mark.start() if mark else len(page)
            k = mark_at
            if k < len(page) and page[k] == ">":
                return k + 1
            close = page.find(page[k], k + 1) if k < len(page) and k not in dead else -1
            if close < 0:
                dead.update([*met, k])
                return None
            met.append(k)
            place = close + 1

    while opening := _OPENING.search(page, at):
        start = opening.start()
        if opening[1]:
            end = page.find("-->", opening.end())
            at = end + 3 if end >= 0 else len(page)
            yield Tag(start, at)
        elif start > last:
            # Nothing ends any more, but a comment may still begin.
            at = page.find("<!--", start)
            if at < 0:
                return
        elif opening[2]:
            at = page.index(">", start) + 1
            yield Tag(start, at)
        elif not opening[3] and (raw := _RAW_NAME.match(opening[4])):
            closes = re.compile(rf"</{raw[0]}\s*>", re.I).search(page, page.index(">", start) + 1)
            at = closes.end() if closes else len(page)
            yield Tag(start, at)
        elif (end := end_of(opening.end())) is not None:
            yield Tag(start, end, opening[4].lower(), bool(opening[3]), page[opening.end():end - 1])
            at = end
        else:
            at = start + 1


_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    """White-space normalised text and, outermost first, the enclosing elements with their class words."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    link_share: float = 0.0


def _names(attributes: str) -> tuple[str, ...]:
    if not attributes:
        return ()
    found = (v for m in _ATTRIBUTE.finditer(attributes) for v in m.groups()[1:] if v)
    return tuple(w for v in found for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", v).lower()))


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order. Broken, nested and unclosed markup is read as it comes."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    # For each open element: whether it or one around it is hidden, and is one that holds no blocks.
    within: list[tuple[bool, bool]] = []
    pieces: list[str] = []
    linked, in_link = 0, 0
    page, at = page or "", 0

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, tuple(stack), linked / max(1, sum(map(len, pieces)))))
            pieces.clear()
        linked = 0

    def cut(depth: int) -> None:
        del stack[depth:], within[depth:]

    def hidden() -> bool:
        return bool(within) and within[-1][0]

    for tag in tags(page):
        name = tag.name
        if stack and stack[-1][0] == "head" and (page[at:tag.start].strip() or name and not tag.closing and name not in IN_HEAD):
            cut(len(stack) - 1)
        if tag.start > at and not hidden():
            pieces.append(page[at:tag.start])
            linked += (tag.start - at) * (in_link > 0)
        at = tag.end
        if not name:
            continue
        if name == "a":
            in_link = 0 if tag.closing else 1
        if name == "br":
            pieces.append(" ")
        if name in INLINE or name == "br":
            continue
        close()
        if tag.closing:
            open_at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if open_at is not None:
                cut(open_at)
        else:
            ended = SELF_CLOSING.get(name, set()) | ({"p"} if name in ENDS_PARAGRAPH else set())
            if within and within[-1][1] and (name in ENDS_PARAGRAPH or name in SELF_CLOSING or name in NO_BLOCKS):
                cut(next(k for k, (_, none) in enumerate(within) if none))
            while stack and stack[-1][0] in ended:
                cut(len(stack) - 1)
            if name not in VOID and not tag.attributes.endswith("/") and len(stack) < DEEPEST:
                around = within[-1] if within else (False, False)
                stack.append((name, _names(tag.attributes)))
                within.append((around[0] or name in HIDDEN, around[1] or name in NO_BLOCKS))
    if stack and stack[-1][0] == "head" and page[at:].strip():
        cut(len(stack) - 1)
    if not hidden():
        pieces.append(page[at:])
    close()
    return out


#: Words that name page furniture in elements, classes and roles.
OTHER_ELEMENTS = frozenset("nav header footer aside form menu dialog button fieldset".split())
FURNITURE = (
    "nav", "navigation", "menu", "breadcrumb", "sidebar", "footer", "header", "ad", "ads", "advert", "advertisement", "banner", "sponsored",
    "promo", "cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login",
    "search", "form", "comment", "comments", "reply", "discussion", "related", "recommended", "share", "social", "widget", "tags",
    "pagination", "copyright", "toolbar", "masthead", "disclaimer", "gdpr", "respond",
)
#: Elements that hold running text of articles, outermost first.
IN_ARTICLES = (
    ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("table", "tr", "td"), ("figure", "figcaption"),
    ("section", "p"), ("section", "h2"), ("div", "p"), ("div",), ("pre",), ("dl", "dd"), ("h2",), ("h3",),
)
CONTENT = ("article", "content", "post", "entry", "story", "body", "main", "text")


def _shape(text: str) -> Iterator[str]:
    words = text.count(" ") + 1
    yield f"words={min(words.bit_length(), 7)}"
    yield f"ends={text[-1] if text[-1] in '.!?:;,' else 'other'}"
    if any(c in text for c in "©®™|·»"):
        yield "marks"


def _kind(tag: str, names: tuple[str, ...]) -> str | None:
    """What an element says about the blocks in it, if anything."""
    if tag in OTHER_ELEMENTS or any(w in FURNITURE for w in names):
        return "furniture"
    return "content" if tag in ("article", "main") or any(w in CONTENT for w in names) else None


@functools.lru_cache(maxsize=4096)
def _path_features(path: tuple[tuple[str, tuple[str, ...]], ...]) -> tuple[str, ...]:
    out = {f"in={tag}" for tag, _ in path}
    out |= {f"named={w}" for _, names in path for w in names if not w.isdigit()}
    kinds = [k for k in (_kind(*element) for element in path) if k]
    out |= {f"under={k}" for k in kinds}
    return (*sorted(out), f"leaf={path[-1][0] if path else None}", f"nearest={kinds[-1] if kinds else None}")


def features(block: Block) -> list[str]:
    """Binary features: ancestor tags and what they are called, position in the tree, shape of the text."""
    return ["bias", *_path_features(block.path), f"links={round(3 * block.link_share)}", *_shape(block.text)]


def is_article(block: Block) -> bool:
    """The label that a page's semantic elements give."""
    tags = [tag for tag, _ in block.path]
    inside = next((k for k, tag in enumerate(tags) if tag in ("article", "main")), None)
    if inside is None or any(tag in OTHER_ELEMENTS for tag in tags[inside:] if tag != "header"):
        return False
    return not any(w in FURNITURE for _, names in block.path[inside:] for w in names)


def has_landmark(page: list[Block]) -> bool:
    """Whether the page says where its article is; of others no label is known."""
    return any(tag in ("article", "main") for block in page for tag, _ in block.path)


def variants(page: list[Block], rng: random.Random) -> Iterator[tuple[list[Block], list[int]]]:
    """A labelled page as it is, with furniture of a kind it may lack, and with its landmarks renamed."""
    labels = [int(is_article(b)) for b in page]
    yield page, labels
    other = [b for b, label in zip(page, labels) if not label] or page
    mixed, marks = [], []
    for block, label in zip(page, labels):
        if label and rng.random() < 0.2:  # articles hold lists, quotations, tables and sections
            inside = tuple((tag, ()) for tag in rng.choice(IN_ARTICLES))
            block = Block(block.text, (*block.path[:-1], *inside), rng.choice((0.0, 0.0, block.link_share)))
        mixed.append(block)
        marks.append(label)
        if rng.random() < 0.3:
            word = rng.choice(FURNITURE)
            element = rng.choice(("div", "section", "aside", "form", "ul", "nav", "header", "footer"))
            # Furniture stands inside or beside the article, and holds running text too.
            base = block.path[:rng.randint(1, max(1, len(block.path)))]
            if element in ("header", "footer"):
                base = base[:next((k for k, (tag, _) in enumerate(base) if tag in ("article", "main")), len(base))]
            text = rng.choice(other).text if rng.random() < 0.4 else rng.choice(page).text
            for _ in range(rng.randint(1, 3)):
                mixed.append(Block(text, (*base, (element, (word,)), (rng.choice(("p", "div", "li", "h3")), ())), rng.random() ** 3))
                marks.append(0)
    yield mixed, marks
    # The same without landmarks: what they are shows in their class only.
    names = {"article": ("div", (rng.choice(CONTENT),)), "main": ("div", (rng.choice(CONTENT),))}
    names |= {tag: ("div", (rng.choice(FURNITURE),)) for tag in OTHER_ELEMENTS}
    renamed = [Block(b.text, tuple((names.get(tag, (tag, w))[0], w or names.get(tag, (tag, w))[1]) for tag, w in b.path), b.link_share) for b in mixed]
    yield renamed, marks


@dataclass
class Chain:
    """Weights of the two labels for each feature, and of the four transitions."""

    index: dict[str, int] = field(default_factory=dict)
    emit: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def rows(self, page: list[Block]) -> list[list[int]]:
        return [[self.index[f] for f in features(b) if f in self.index] for b in page]

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.emit[r].sum(axis=0) if r else (0.0, 0.0) for r in rows])

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label) of each block and the expected transitions (forward-backward in logarithms)."""
        n = len(scores)
        ahead, back = scores.copy(), np.zeros_like(scores)
        for t in range(1, n):
            ahead[t] += np.logaddexp.reduce(ahead[t - 1][:, None] + self.move, axis=0)
        for t in range(n - 2, -1, -1):
            back[t] = np.logaddexp.reduce(self.move + (scores[t + 1] + back[t + 1])[None, :], axis=1)
        whole = np.logaddexp.reduce(ahead[-1])
        moves = np.zeros((2, 2))
        for t in range(1, n):
            moves += np.exp(ahead[t - 1][:, None] + self.move + (scores[t] + back[t])[None, :] - whole)
        return np.exp(ahead + back - whole), moves

    def decode(self, page: list[Block]) -> list[int]:
        """The most probable labels (Viterbi); ties go to ``other``."""
        if not page:
            return []
        scores = self.scores(self.rows(page))
        best, back = scores[0], []
        for t in range(1, len(scores)):
            ways = best[:, None] + self.move
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + scores[t]
        labels = [int(best.argmax())]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def train(pages: list[list[Block]], seed: int = 5) -> Chain:
    """Stochastic gradient ascent (AdaGrad) on the penalised log-likelihood of the labelled pages."""
    rng = random.Random(seed)
    data = [v for page in pages if has_landmark(page[:SAMPLE_BLOCKS]) for v in variants(page[:SAMPLE_BLOCKS], rng)]
    model = Chain()
    for page, _ in data:
        for block in page:
            for f in features(block):
                model.index.setdefault(f, len(model.index))
    model.emit = np.zeros((len(model.index), 2))
    seen_emit, seen_move = np.full_like(model.emit, 1e-8), np.full((2, 2), 1e-8)
    coded = [(model.rows(page), np.array(labels)) for page, labels in data]
    for _ in range(EPOCHS):
        rng.shuffle(coded)
        for rows, labels in coded:
            expected, moves = model.marginals(model.scores(rows))
            error = np.eye(2)[labels] - expected
            flat = np.concatenate([np.array(r, np.int64) for r in rows])
            grad = np.zeros_like(model.emit)
            np.add.at(grad, flat, np.repeat(error, [len(r) for r in rows], axis=0))
            grad -= PENALTY * model.emit
            move = np.zeros((2, 2))
            np.add.at(move, (labels[:-1], labels[1:]), 1.0)
            move -= moves + PENALTY * model.move
            seen_emit += grad**2
            seen_move += move**2
            model.emit += RATE * grad / np.sqrt(seen_emit)
            model.move += RATE * move / np.sqrt(seen_move)
    return model


def fit(pages: DataFrame, column: str = "html") -> Chain:
    """A chain trained on SAMPLE_PAGES different pages with a landmark at most, those of the lowest hashes."""
    prepare(pages.sparkSession)
    marked = pages.where(F.col(column).rlike(r"(?i)<(article|main)[\s>]")).select(F.xxhash64(column).alias("hash"), F.col(column).alias("page"))
    lowest = [r[0] for r in marked.select("hash").distinct().orderBy("hash").limit(SAMPLE_PAGES).collect()]
    drawn = marked.where(F.col("hash").isin(lowest)).groupBy("hash").agg(F.first("page").alias("page")).collect()
    return train([blocks(r["page"]) for r in sorted(drawn, key=lambda r: r["hash"])])


def main_text(spark: SparkSession, model: Chain) -> Callable[[Column], Column]:
    """A column function: the article's blocks in page order, joined by one space.

    NULL and empty pages, and pages without article blocks, give the empty string. Whole pages are read.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        chain = shared.value
        for pages in batches:
            read = (blocks(p) for p in pages)
            yield pd.Series([" ".join(b.text for b, k in zip(page, chain.decode(page)) if k) for page in read], dtype=object)

    return extract
