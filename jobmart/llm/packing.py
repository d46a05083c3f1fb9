"""Packing of documents into sequences of fixed length by a grouping genetic algorithm.

The lengths are dealt at random into pools of bounded size. For each pool several islands evolve
packings of their own: a crossover takes whole well-filled bins of one parent into the other, drops the
other's bins that hold the same documents, and puts the displaced documents by best fit. After each
epoch an island gets the best packing of its neighbour. The best packing of all islands is used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import prepare, written
from jobmart.llm.tokens import Encoding, encoder

#: Pieces per pool; the pools are independent, so work grows with the input and a task does not.
POOL_ITEMS = 8000

ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 4, 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "uid long, sequence_id long, offset long"
STATE = "pool long, island int, uid long, length long, bin long"

STATE_SCHEMA = pa.schema([
    ("pool", pa.int64()), ("island", pa.int32()), ("uid", pa.int64()), ("length", pa.int64()), ("bin", pa.int64()),
])
PIECE_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
])


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all of full length but the first, which takes the remainder."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n_tokens, capacity))]


def pieces(docs: DataFrame, encoding: Encoding, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of every document (a NULL text is empty and has the end id only)."""
    prepare(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(encoding)
        for batch in batches:
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((key, k, start, length, zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, PIECE_SCHEMA.types)], schema=PIECE_SCHEMA)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(of, PIECES)


class Bins:
    """Open bins by what is free in them; a set bit of ``free`` says that some bin has that much."""

    def __init__(self, capacity: int, next_bin: int):
        self.capacity, self.next_bin = capacity, next_bin
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.free = 0

    def add(self, bin_id: int, room: int) -> None:
        if room:
            self.by_room[room].append(bin_id)
            self.free |= 1 << room

    def put(self, length: int) -> int:
        """Best fit: the bin with the least sufficient room, or a new one."""
        fitting = self.free >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_id = self.by_room[room].pop()
            if not self.by_room[room]:
                self.free ^= 1 << room
        else:
            room, bin_id = self.capacity, self.next_bin
            self.next_bin += 1
        self.add(bin_id, room - length)
        return bin_id


def _renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].reshape(-1)


def _fill(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths).astype(np.int64)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: smaller is better."""
    fill = _fill(bins, lengths)
    return len(fill), -float(np.square(fill / capacity).sum())


def placed(order: np.ndarray, lengths: np.ndarray, bins: np.ndarray, opened: Bins) -> np.ndarray:
    for item in order.tolist():
        bins[item] = opened.put(int(lengths[item]))
    return _renumbered(bins)


def refit(kept: np.ndarray, moved: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Put the ``moved`` items, longest first, into the packing ``kept`` (-1 for moved items)."""
    bins = kept.copy()
    rest = bins >= 0
    bins[rest] = _renumbered(bins[rest])
    fill = _fill(bins[rest], lengths[rest])
    opened = Bins(capacity, len(fill))
    for bin_id, room in enumerate((capacity - fill).tolist()):
        opened.add(bin_id, room)
    return placed(moved[np.argsort(-lengths[moved], kind="stable")], lengths, bins, opened)


def crossover(
    a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator
) -> np.ndarray:
    """Whole well-filled bins of ``b`` go into ``a``; what they displace is put by best fit."""
    fill = _fill(b, lengths)
    chosen = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < rng.uniform(0.1, 0.5))
    injected = chosen[b]
    hit = np.zeros(a.max() + 1, bool)
    hit[a[injected]] = True
    displaced = hit[a] & ~injected
    child = np.where(injected, b + a.max() + 1, a)
    child[displaced] = -1
    return refit(child, np.flatnonzero(displaced), lengths, capacity)


def mutated(a: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Dissolve the emptiest bins and a few others, and put their items again."""
    fill = _fill(a, lengths)
    emptiest = np.argsort(fill, kind="stable")[:1 + len(fill) // 200]
    gone = rng.random(len(fill)) < 0.02
    gone[emptiest] = True
    moved = gone[a]
    return refit(np.where(moved, -1, a), np.flatnonzero(moved), lengths, capacity)


def evolve(
    lengths: np.ndarray, elites: list[np.ndarray], capacity: int, rng: np.random.Generator
) -> np.ndarray:
    """The best packing after ``GENERATIONS``, starting from ``elites`` and fresh best-fit packings."""
    everyone = list(elites)
    while len(everyone) < POPULATION:
        # Decreasing best fit first, then the same with lengths blurred.
        blur = 1 + (0.0 if not everyone else 0.08) * rng.standard_normal(len(lengths))
        order = np.argsort(-lengths * blur, kind="stable")
        everyone.append(placed(order, lengths, np.full(len(lengths), -1), Bins(capacity, 0)))
    least = -(-int(lengths.sum()) // capacity)
    everyone.sort(key=lambda p: fitness(p, lengths, capacity))
    for _ in range(GENERATIONS):
        if everyone[0].max() + 1 == least:
            break  # no packing has fewer bins
        children = []
        for _ in range(POPULATION - 1):
            i, j = rng.choice(len(everyone), 2, replace=False)
            child = crossover(everyone[i], everyone[j], lengths, capacity, rng)
            children.append(mutated(child, lengths, capacity, rng))
        everyone = sorted(everyone + children, key=lambda p: fitness(p, lengths, capacity))[:POPULATION]
    return everyone[0]


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """uid, sequence_id, offset of items ``(uid long, length long)``; lengths from 1 to ``capacity``.

    ``items`` is a written table with unique ids, as it is read several times. An item of full length
    is a sequence of its own. No items give no rows.
    """
    small = items.where(F.col("length") < capacity)
    n_pools = -(-small.count() // POOL_ITEMS) or 1
    dealt = small.select(F.pmod(F.xxhash64("uid"), F.lit(n_pools)).alias("pool"), "uid", "length")
    state = dealt.withColumn("bin", F.lit(-1).cast("long")).withColumn("origin", F.lit(0)) \
        .withColumn("island", F.explode(F.array([F.lit(i) for i in range(ISLANDS)])))

    def island(epoch: int):
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by([("origin", "ascending"), ("uid", "ascending")])
            origin, bins = table["origin"].to_numpy(), table["bin"].to_numpy()
            own = table.filter(pa.array(origin == 0))
            lengths = own["length"].to_numpy()
            elites = [_renumbered(bins[origin == o]) for o in np.unique(origin) if (bins[origin == o] >= 0).all()]
            seed = (epoch, table["pool"][0].as_py(), table["island"][0].as_py())
            best = evolve(lengths, elites, capacity, np.random.default_rng(seed))
            return pa.table([own["pool"], own["island"], own["uid"], own["length"], pa.array(best)], schema=STATE_SCHEMA)

        return run

    for epoch in range(EPOCHS):
        evolved = state.select("pool", "island", "uid", "length", "bin", "origin") \
            .groupBy("pool", "island").applyInArrow(island(epoch), STATE)
        if epoch < EPOCHS - 1:
            moves = F.explode(F.array(
                F.struct(F.col("island"), F.lit(0).alias("origin")),
                F.struct(F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.lit(1).alias("origin")),
            ))
            state = evolved.select("pool", "uid", "length", "bin", moves.alias("m")) \
                .select("pool", "uid", "length", "bin", "m.island", "m.origin")

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by([("island", "ascending"), ("uid", "ascending")])
        islands = table["island"].to_numpy()
        best = min(
            (table.filter(pa.array(islands == i)) for i in np.unique(islands)),
            key=lambda t: fitness(t["bin"].to_numpy(), t["length"].to_numpy(), capacity),
        )
        bins, lengths = best["bin"].to_numpy(), best["length"].to_numpy()
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.r_[True, np.diff(bins[order]) > 0]
        begin = ends - lengths[order]
        offsets = np.empty(len(order), np.int64)
        offsets[order] = begin - np.maximum.accumulate(np.where(first, begin, 0))
        return pa.table(
            {"uid": best["uid"], "sequence_id": pa.array((table["pool"][0].as_py() << 32) + bins),
             "offset": pa.array(offsets)}
        )

    packed = evolved.groupBy("pool").applyInArrow(settle, PACKED)
    full = items.where(F.col("length") == capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)


def pack_documents(
    docs: DataFrame, encoding: Encoding, capacity: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of ``docs`` is packed, repeated ones and rows without an id too.
    """
    found = written(
        pieces(docs, encoding, capacity, doc_id, text).withColumn("uid", F.monotonically_increasing_id()), "pieces"
    )
    return found.join(pack(found.select("uid", "length"), capacity), "uid").drop("uid")
