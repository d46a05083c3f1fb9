"""Near duplicates by MinHash with tensored banding, verified on full shingle sets.

Two small collections of bands are computed; the table keys are all pairs of a band of the first and a
band of the second, so that HALF * HALF tables need 2 * HALF bands. Two sets of Jaccard similarity s
meet in a table with probability (1 - (1 - s ** ROWS) ** HALF) ** 2: 0.9999 at 0.8, 0.72 at 0.5, 0.10 at 0.3.

Equal sets are one class and enter the search once. Within a table no pairs are listed. Every class is compared
to the most central class of each of its tables, its center, on full sets. What a class has more and less
than a center is its difference; two classes around one center have a similarity that follows from
the sizes of their differences and of what these share. So those near the center are linked with it, and a pair
of which one is not can be linked only if both differences share more than a number of shingles that is known
beforehand. A prefix join over the differences, rarest shingles first, finds the pairs that can, and those are
compared on full sets. No pair that shares a table and may be linked is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import discard, marked_rows, prepare, row_bitmap, row_hash, same, without_rows, written
from jobmart.llm.components import components
from jobmart.llm.words import hashes, words

#: Words in a shingle, and the similarity in percent from which on sets are linked.
SHINGLE_WORDS, PERCENT = 5, 80

#: Bands in each of the two collections, and minhashes in a band.
HALF, ROWS = 14, 3

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of SplitMix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEEDS = _mix(np.arange(1, 4 * HALF * ROWS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))

#: Each minhash is the least of ``x * factor + shift`` over a set's hashes, which are scrambled already.
_FACTORS, _SHIFTS = _SEEDS[::2] | _U(1), _SEEDS[1::2]


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, none without words."""
    flat, at = words(texts)
    if not len(flat):
        return [np.empty(0, np.uint64)] * len(texts)
    coded = flat.dictionary_encode()
    word = hashes(coded.dictionary).view(np.uint64)[coded.indices.to_numpy()]
    starts = np.searchsorted(at, np.arange(len(texts) + 1))
    state = _mix(word)
    whole = max(0, len(word) - size + 1)
    rolled = state[:whole]
    for k in range(1, size):
        rolled = _mix(rolled + word[k:k + whole])
    sets = []
    for begin, end in zip(starts, starts[1:]):
        if end - begin >= size:
            sets.append(np.unique(rolled[begin:end - size + 1]))
        elif end > begin:
            one = state[begin:begin + 1]
            for k in range(begin + 1, end):
                one = _mix(one + word[k:k + 1])
            sets.append(_mix(one ^ _U(end - begin)))  # not equal to a shingle that starts alike
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Per non-empty set the keys of its 2 * HALF bands."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), 2 * HALF), np.uint64)
    for band in range(2 * HALF):
        key = np.full(len(sets), _SHIFTS[band])
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = _mix(key + np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], starts))
        out[:, band] = key
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """Per row: doc_id, row, n_shingles, set_id (128 bits as text; NULL for an empty set), bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(2), size)
            full = [s for s in sets if len(s)]
            keys = iter(bands(full).view(np.int64)) if full else iter(())
            yield pa.record_batch([
                *batch.columns[:2], pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                pa.array([next(keys).tolist() if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], ["doc_id", "row", "n_shingles", "set_id", "bands"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(sign, "doc_id long, row long, n_shingles long, set_id string, bands array<long>")


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key another row has too.

    The keys are counted before they are shuffled. A class has one row in each of many tables, so no
    key has more than a small share of the rows, even if all classes are near copies.
    """
    return rows.join(rows.groupBy(key).count().where("count > 1").select(key), key, "left_semi")


def tables(classes: DataFrame) -> DataFrame:
    """(bucket, node): the tensored tables, without entries that stand alone.

    A band that nobody shares can be part of no shared pair, so it is left out before pairs are formed.
    """
    band = classes.select("node", F.posexplode("bands").alias("k", "band"))
    entry = F.col("band")
    left = _repeated(band, "band").groupBy("node").agg(  # HALF values at most in each
        F.collect_list(F.when(F.col("k") < HALF, entry)).alias("first"),
        F.collect_list(F.when(F.col("k") >= HALF, entry)).alias("second"),
    )
    pairs = left.select("node", F.explode("first").alias("a"), "second").select("node", "a", F.explode("second").alias("b"))
    entries = written(pairs.select(F.xxhash64("a", "b").alias("bucket"), "node"), "near-entries")
    members = written(_repeated(entries, "bucket"), "near-tables")
    discard(entries)
    return members


def full_sets(docs: DataFrame, classes: DataFrame, text: str, size: int, doc_id: str) -> DataFrame:
    """(node, shingles) of the given classes, from the text of one member each; texts are not shuffled."""
    wanted = row_bitmap(classes, "row")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = marked_rows(wanted.value, batch.column(0).to_numpy())
            batch = batch.filter(pa.array(chosen))
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), size)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["row", "shingles"])

    rows = docs.select(row_hash(doc_id, text).alias("row"), F.col(text).alias("text"))
    found = rows.mapInArrow(expand, "row long, shingles array<long>")
    return found.join(classes.select("row", "node"), "row").dropDuplicates(["node"]).select("node", "shingles")


def around_centers(members: DataFrame) -> DataFrame:
    """(center, node): each class with the center of each of its tables, once.

    A table's center is the class that meets most others in all its tables.
    """
    sizes = members.groupBy("bucket").count()
    weights = members.join(sizes, "bucket").groupBy("node").agg(F.sum("count").alias("weight"))
    best = members.join(weights, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("best"))
    return members.join(best, "bucket").select(F.col("best.node").alias("center"), "node").where("node != center").distinct()


def differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(center, node, slack, height, apart): what each class has less and more than its center, on full sets.

    With c shingles in the center, l missing and e further ones in a class, two classes share
    c - l - l' - e + the number of shingles in both differences. So for a similarity of ``percent`` the differences
    must share (height + height' - slack) / (100 + percent) shingles, height being 100 l + percent e and
    slack (100 - percent) c. The center itself has height 0.
    """
    middle = sets.select(F.col("node").alias("center"), F.col("shingles").alias("middle"))
    both = pairs.join(middle, "center").join(sets, "node") \
        .select("center", "node", F.size("middle").alias("c"), F.array_except("middle", "shingles").alias("less"),
                F.array_except("shingles", "middle").alias("more"))
    height = 100 * F.size("less").cast("long") + percent * F.size("more")
    return both.select("center", "node", ((100 - percent) * F.col("c").cast("long")).alias("slack"), height.alias("height"),
                       F.concat("less", "more").alias("apart"))


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", (F.size("left") + F.size("right")).cast("long").alias("n"), F.size(F.array_intersect("left", "right")).alias("common"))
    return both.where((100 + percent) * F.col("common") >= percent * F.col("n")).select("a", "b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) with the labels that ``links`` (a, b) join together."""
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    across = links.join(one, "a").join(two, "b").where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    across = written(across, "near-bridges")
    further = components(across).select(F.col("node").alias("label"), F.col("label").alias("further"))
    merged = written(labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "near-labels")
    discard(across)
    return merged


def possible(apart: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes around one center, in different components, that may be linked.

    Of such a pair at least the higher one is not linked with the center, so it probes with its prefix the
    prefixes of all others. The rarest shingles of a difference come first; two differences that share k of
    their shingles meet within the first (size - k + 1) of both, and at their first meeting have k - 1 more to
    come. Shingles of one difference only take places, and travel no further.
    """
    whole = 100 + percent
    labelled = apart.join(labels, "node")
    mixed = labelled.groupBy("center").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.col("height") - F.col("slack")).alias("over"),
    ).where("n > 1 AND low < high AND over > 0").select("center")
    searched = labelled.join(mixed, "center", "left_semi")
    searched = written(searched.withColumn("size", F.size("apart").cast("long")), "near-searched")
    places = searched.select("center", "node", F.explode("apart").alias("shingle"))
    counts = places.groupBy("center", "shingle").count().where("count > 1")
    own = Window.partitionBy("center", "node")
    ordered = places.join(counts, ["center", "shingle"]) \
        .withColumns({"rank": F.row_number().over(own.orderBy("count", "shingle")), "shared": F.count("*").over(own)}) \
        .join(searched.drop("apart"), ["center", "node"]) \
        .withColumn("place", F.col("size") - F.col("shared") + F.col("rank"))
    # A lower class meets one that is at least as high and higher than the slack; a probe one that is not too small.
    least_met = F.ceil(F.greatest(F.col("height"), 2 * F.col("height") - F.col("slack")) / whole)
    least_probed = F.ceil((F.col("height") - F.col("slack")) / 100)
    ordered = written(ordered.select(
        "center", "shingle", "node", "label", "slack", "height", "size", "place",
        (F.col("place") <= F.col("size") - F.greatest(least_met, F.lit(1)) + 1).alias("met"),
        ((F.col("height") > F.col("slack")) & (F.col("place") <= F.col("size") - F.greatest(least_probed, F.lit(1)) + 1)).alias("probes"),
    ).where("met OR probes"), "near-prefixes")
    low = ordered.where("met").select("center", "shingle", *(F.col(c).alias(f"low_{c}") for c in ("node", "label", "height", "size", "place")))
    to_come = F.least(F.col("size") - F.col("place"), F.col("low_size") - F.col("low_place")) + 1
    fits = (F.col("label") != F.col("low_label")) & (F.struct("height", "node") > F.struct("low_height", "low_node")) \
        & (whole * to_come >= F.col("height") + F.col("low_height") - F.col("slack"))
    pairs = ordered.where("probes").join(low, ["center", "shingle"]).where(fits)
    pairs = written(pairs.select(F.least("node", "low_node").alias("a"), F.greatest("node", "low_node").alias("b")).distinct(), "near-candidates")
    discard(searched, ordered)
    return pairs


def linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the ``members`` of tables: components of all verified links between classes that share one."""
    pairs = written(around_centers(members), "near-centers")
    apart = written(differences(pairs, sets, percent), "near-differences")
    discard(pairs)
    alone = sets.select("node", F.col("node").alias("label"))
    near = _merged(alone, apart.where("height <= slack").select(F.col("center").alias("a"), F.col("node").alias("b")))
    candidates = possible(apart, near, percent)
    labels = _merged(near, similar(candidates, sets, percent))
    discard(apart, near, candidates)
    return labels


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, row, n_shingles, component_id, kept.

    ``component_id`` is the smallest id that links lead to, the row's own included; its row is kept. A
    text without words (NULL, empty) has an empty set and is linked with nothing. Rows without an id
    come after any id. Rows repeated in full are all kept if one is. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = written(signatures(docs, doc_id, text, size), "near-signatures")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    equal = rows.where("n_shingles > 0").groupBy("set_id").agg(
        F.min(place).alias("low"), F.first("bands").alias("bands")
    )
    classes = written(
        equal.select(F.monotonically_increasing_id().alias("node"), "set_id", "low", F.col("low.row").alias("row"), "bands"),
        "near-classes",
    )
    members = tables(classes)
    candidates = classes.join(members.select("node").distinct(), "node", "left_semi")
    candidates = written(candidates.select("node", "row"), "near-nodes")
    sets = written(full_sets(docs, candidates, text, size, doc_id), "near-sets")
    labels = linked(members, sets, percent)
    discard(members, candidates, sets)
    first = classes.join(labels, "node").groupBy("label").agg(F.min("low").alias("first"))
    # Landed, so that Spark can split the classes of a component that holds many.
    first = written(first, "near-first")
    found = classes.join(labels, "node", "left").join(first, "label", "left") \
        .select("set_id", F.coalesce("first", "low").alias("first"))
    own = rows.join(found, "set_id", "left").withColumn("first", F.coalesce("first", place))
    kept = same(F.col("first.doc_id"), F.col("doc_id")) & (F.col("first.row") == F.col("row"))
    return own.select("doc_id", "row", "n_shingles", F.col("first.doc_id").alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of linked texts, with their columns as they are."""
    groups = near_groups(docs, doc_id, text, size, percent)
    return without_rows(docs, groups.where("not kept"), doc_id, text)
