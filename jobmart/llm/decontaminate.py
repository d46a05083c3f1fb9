"""Benchmark passages in documents, also with other numbers, names and units.

Words are canonicalised to templates: numbers, units after a number, and capitalised words within a
sentence become typed placeholders. All windows of WINDOW template words of the documents are joined by
hash to those of the benchmark; windows that are mostly placeholders are hashed by their literal words.
A document leaks an item if it holds enough of the item's windows on neighbouring diagonals and the slots
agree: the same value of the item always stands for the same value in the document. Everything is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import row_hash, same, without_rows, written
from jobmart.llm.grams import ascii_words, complete, rolled

#: Template words in a window; items of fewer words are searched by windows of SHORT_WINDOW words.
WINDOW, SHORT_WINDOW = 8, 4

#: Placeholders at most in a window that is matched as a template; others say too little and are matched literally.
SLOTS = {WINDOW: 3, SHORT_WINDOW: 1}

#: Share of an item's windows that a document must hold; a short item must be there in full.
COVERED = 0.5

#: Or the share of its words that the windows cover: each changed word takes up to WINDOW windows along.
WORDS_COVERED = 0.75

#: Or so many consecutive windows (RUN + WINDOW - 1 words), whatever share of a long item they are.
RUN = 13

#: Diagonals at most this far apart are one passage, with words inserted or dropped.
DRIFT = 3

#: Share of an item's distinct slot values that must stand for one value each.
CONSISTENT = 0.8

#: Windows of a benchmark (16 bytes each) up to which they are broadcast; larger ones are shuffled.
BROADCAST_WINDOWS = 1_000_000

#: Slots of the table that names candidate rows in the second scan: a bound for its broadcast.
ROW_SLOTS = 1 << 18

# Units of measure and money that may follow a number.
UNITS = (
    "mm cm dm m km inch inches ft feet foot yd yard yards mile miles mg g kg t lb lbs oz pound pounds ml cl l liter "
    "liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years percent dollar dollars euro euros cent cents usd eur kmh mph degrees celsius fahrenheit "
    "watt watts kw kwh volt volts joule joules hz khz mhz ghz kb mb gb tb"
)

_NAME, _UNIT = "\x01", "\x02"
_SEPARATORS = r"[\x00\x03-\x2F\x3A-\x5E\x60\x7B-\x7F]+"


def template_words(text: Column) -> Column:
    """Words with a mark before names and units; decimal points become part of their number."""
    # The blank first: the pattern is tried at blanks only.
    named = F.regexp_replace(text, r" (?<=[\p{Ll}\d,;:] )(?=\p{Lu}\p{Ll})", " " + _NAME)
    whole = F.regexp_replace(named, r"(?<=\d)[.,](?=\d)", "_")
    units = F.regexp_replace(whole, rf"(?i)(?<=\d)[ ]?(?=(?:{'|'.join(UNITS.split())})\b)", " " + _UNIT)
    return ascii_words(F.when(text.rlike(r"\d"), units).otherwise(named), _SEPARATORS)


def template_hashes(words: Column) -> Column:
    """Hashes of template words; 1 for a name, 2 for a unit, 3 for a number."""

    def one(word: Column) -> Column:
        first = F.ascii(word)
        return F.when(first > 57, F.xxhash64(word)).when(first > 2, F.lit(3).cast("long")).otherwise(first.cast("long"))

    return F.transform(words, one)


def _is_slot(value: Column) -> Column:
    return value.between(1, 3)


def items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words, width): the templates, each with the window width it is searched by."""
    rows = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()) \
        .select(F.col(item_id).alias("item"), template_words(F.col(text)).alias("words")).distinct()
    width = F.when(F.size("words") >= WINDOW, WINDOW).otherwise(SHORT_WINDOW)
    return rows.withColumn("width", width).where(F.size("words") >= SHORT_WINDOW)


def literal_hashes(words: Column) -> Column:
    """Hashes of the words without their marks; none for words too few of which are slots for a dense window."""
    slots = F.size(F.filter(words, lambda w: F.ascii(w) <= 57))
    plain = F.transform(words, lambda w: F.xxhash64(F.translate(w, _NAME + _UNIT, "")))
    return F.when(slots > min(SLOTS.values()), plain).otherwise(F.array().cast("array<bigint>"))


def with_grams(templates: DataFrame, width: int) -> tuple[DataFrame, Column]:
    """The gram at each place of ``words``: of the template, or literally where it has more than SLOTS slots.

    As an expression over columns that are added: of a column to explode Spark would infer a filter, and
    compute all of it anew there.
    """
    some = templates.withColumn("hashes", template_hashes(F.col("words"))).withColumn("literal", literal_hashes(F.col("words")))
    some = some.withColumn("grams", F.col("hashes")) \
        .withColumn("slots", F.when(F.size("literal") > 0, F.transform("hashes", lambda h: _is_slot(h).cast("int")))
                    .otherwise(F.array().cast("array<int>")))
    some = rolled(rolled(some, "grams", width), "literal", width)
    have = 1
    while have < width:
        later = F.slice("slots", have + 1, F.size("slots"))
        some = some.withColumn("slots", F.zip_with("slots", later, lambda a, b: a + F.coalesce(b, F.lit(0))))
        have *= 2
    both = F.zip_with("grams", F.arrays_zip("slots", "literal"),
                      lambda g, o: F.when(o["slots"] > SLOTS[width], o["literal"]).otherwise(g))
    grams = F.when(F.size("slots") > 0, both).otherwise(F.col("grams"))
    return some, complete(grams, F.size("words"), width)


def item_windows(templates: DataFrame, width: int) -> DataFrame:
    """(gram, item, words, at, n_windows) of the items searched by this width."""
    some, grams = with_grams(templates.where(F.col("width") == width).select("item", "words"), width)
    n_windows = F.greatest(F.size("words") - (width - 1), F.lit(0)).alias("n_windows")
    return some.select("item", "words", n_windows, F.posexplode(grams).alias("at", "gram"))


def _hits(docs: DataFrame, windows: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, row, item, words, n_windows, hits): windows that meet on neighbouring diagonals.

    ``hits`` holds (at, diagonal) in order; of several diagonals with one window, the one with most of them counts.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"), template_words(F.col(text)).alias("words"),
    )
    some, grams = with_grams(rows, width)
    every = some.select("doc_id", "row", F.posexplode(grams).alias("place", "gram"))
    if windows.count() <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)
    key = ["doc_id", "row", "item", "words", "n_windows"]
    diagonals = every.join(windows, "gram").withColumn("diagonal", F.col("place") - F.col("at")) \
        .groupBy(*key, "diagonal").agg(F.collect_set("at").alias("ats"))
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order), F.lit(DRIFT + 1)) > DRIFT
    spans = diagonals.withColumn("new", apart.cast("int")).withColumn("span", F.sum("new").over(order)) \
        .withColumn("size", F.size("ats")).select(*key, "span", "size", "diagonal", F.explode("ats").alias("at"))
    # Aggregates and not one expression, which a filter on the hits would have computed anew at each mention.
    return spans.groupBy(*key, "span", "at").agg(F.max_by("diagonal", F.struct("size", -F.col("diagonal"))).alias("diagonal")) \
        .groupBy(*key, "span").agg(F.array_sort(F.collect_list(F.struct("at", "diagonal"))).alias("hits")).drop("span")


def _enough(width: int) -> Column:
    """Whether the hits are enough of the item, by windows, by words or in one run."""
    covered = F.size("hits") >= F.lit(COVERED) * F.col("n_windows")
    following = F.transform("hits", lambda h, i: F.least(
        F.coalesce(F.get(F.col("hits"), i + 1)["at"] - h["at"], F.lit(width)), F.lit(width)))
    words = F.aggregate(following, F.lit(0), lambda a, b: a + b) >= F.lit(WORDS_COVERED) * F.size("words")
    run = F.exists(
        F.transform("hits", lambda h, i: F.get(F.col("hits"), i + (RUN - 1))["at"] - h["at"]), lambda d: d == RUN - 1
    )
    return covered | words | F.coalesce(run, F.lit(False))


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per leaked item of a row: doc_id, row, item_id, first_word, n_words, coverage, consistency, verbatim.

    ``first_word`` and ``n_words`` say where the passage stands, in words of the document; ``coverage`` is
    the share of the item's windows that it holds, ``verbatim`` that all its slots hold the item's own
    values. NULL and empty texts leak nothing; items without an id, without text or of fewer than
    SHORT_WINDOW words are not searched. Rows repeated in full are reported once.
    """
    templates = items(benchmark, item_id, item_text)
    found = None
    for width, enough in ((WINDOW, _enough(WINDOW)), (SHORT_WINDOW, F.size("hits") == F.col("n_windows"))):
        windows = item_windows(templates, width)
        if windows.isEmpty():
            continue
        some = _hits(docs, windows, width, doc_id, text).where(enough).withColumn("width", F.lit(width))
        found = some if found is None else found.unionByName(some)
    if found is None:
        return docs.sparkSession.createDataFrame([], LEAKS)
    found = written(found, "leak-candidates")  # used more than once, and small next to the texts
    first, last = F.get(F.col("hits"), F.lit(0)), F.element_at("hits", -1)
    found = found.withColumn("coverage", F.size("hits") / F.col("n_windows")) \
        .withColumn("first_word", first["at"] + first["diagonal"]) \
        .withColumn("n_words", last["at"] + last["diagonal"] - F.col("first_word") + F.col("width"))
    length = last["at"] - first["at"] + F.col("width")
    found = found.withColumn("with_slots", F.exists(F.slice("words", first["at"] + 1, length), lambda w: F.ascii(w) <= 57))
    plain = found.where("not with_slots").withColumn("consistency", F.lit(1.0)).withColumn("verbatim", F.lit(True))
    checked = _with_slots(found.where("with_slots"), docs, doc_id, text)
    best = F.max_by(
        F.struct("first_word", "n_words", "coverage", "consistency", "verbatim"), F.struct("coverage", -F.col("first_word"))
    )
    columns = ["doc_id", "row", "item", "first_word", "n_words", "coverage", "consistency", "verbatim"]
    return plain.select(columns).unionByName(checked.select(columns)).where(F.col("consistency") >= CONSISTENT) \
        .groupBy("doc_id", "row", "item").agg(best.alias("b")).select(
            "doc_id", "row", F.col("item").cast("long").alias("item_id"),
            F.col("b.first_word").cast("long").alias("first_word"), F.col("b.n_words").cast("long").alias("n_words"),
            F.col("b.coverage").alias("coverage"), F.col("b.consistency").alias("consistency"), F.col("b.verbatim").alias("verbatim"),
        )


LEAKS = (
    "doc_id long, row long, item_id long, first_word long, n_words long, coverage double, consistency double, "
    "verbatim boolean"
)


def _with_slots(found: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``found`` with consistency and verbatim, from the slots' values in the document.

    The texts are scanned again, and only rows that share a slot of a table of bounded size with a
    candidate go on to the join.
    """
    slot = F.pmod(F.col("row"), F.lit(ROW_SLOTS)).alias("slot")
    rows = docs.select(F.col(doc_id).cast("long").alias("d_id"), row_hash(doc_id, text).alias("row"), F.col(text).alias("text"))
    near = rows.withColumn("slot", slot).join(F.broadcast(found.select(slot).distinct()), "slot", "left_semi") \
        .select("d_id", F.col("row").alias("d_row"), template_words(F.col("text")).alias("own")).distinct()
    both = found.join(near, same(found["doc_id"], near["d_id"]) & (found["row"] == near["d_row"]))

    def aligned(hit: Column, i: Column) -> Column:
        # Up to the next window of the same diagonal, or to the end of this one.
        later = F.get(F.col("hits"), i + 1)
        length = F.when(later["diagonal"] == hit["diagonal"], later["at"] - hit["at"]).otherwise(F.col("width"))
        return F.arrays_zip(
            F.slice("words", hit["at"] + 1, length).alias("a"), F.slice("own", hit["at"] + hit["diagonal"] + 1, length).alias("b")
        )

    slots = F.filter(F.flatten(F.transform("hits", aligned)), lambda p: F.ascii(p["a"]) <= 57)
    marks = _NAME + _UNIT
    pairs = F.transform(slots, lambda p: F.struct(F.translate(p["a"], marks, "").alias("a"), F.translate(p["b"], marks, "").alias("b")))
    both = both.withColumn("pairs", F.array_distinct(pairs)).withColumn("values", F.array_distinct(F.transform("pairs", lambda p: p["a"])))
    extra = F.size("pairs") - F.size("values")
    return both.withColumn("consistency", 1 - F.least(extra / F.greatest(F.size("values"), F.lit(1)), F.lit(1.0))) \
        .withColumn("verbatim", F.forall("pairs", lambda p: p["a"] == p["b"]))


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns as they are."""
    return without_rows(docs, leaks(docs, benchmark, doc_id, text), doc_id, text)
