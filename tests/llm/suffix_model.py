"""The whole tree in one place, built level by level: what the distributed scores are compared with."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import written
from jobmart.llm.suffix_tree import DEPTH, END, LEAST, SYMBOLS, symbols, _scored

#: Distinct windows that a counting task holds before it hands on partial counts.
HELD = 1_000_000

#: Places that are scored side by side.
STRIDE = 512

def windows(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all windows of a context and its next symbol, with their counts."""
    read, starts = symbols(texts)
    if not len(read):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.zeros(len(read) - DEPTH, np.int64)
    for k in range(DEPTH + 1):
        codes = (codes << 8) | read[k:len(read) - DEPTH + k]
    return np.unique(codes[_scored(starts)[DEPTH:]], return_counts=True)


def window_counts(docs: DataFrame, text: str, training: str) -> tuple[DataFrame, int]:
    """(code, n) over the training texts, and the bytes of all texts. One pass over the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes, counts = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(codes, kind="stable")
            codes, at = np.unique(codes[order], return_index=True)
            return codes, np.add.reduceat(counts[order], at)

        def rows(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(codes), 100_000):
                yield pa.record_batch([pa.array(codes[at:at + 100_000]), pa.array(counts[at:at + 100_000])], ["code", "n"])

        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            size += sum(len(t) for t in texts if t)
            parts.append(windows([t for t, used in zip(texts, batch.column(1).to_pylist()) if used]))
            if len(parts) > 6:
                parts = [merged()]
                if len(parts[0][0]) > HELD:
                    yield from rows(*parts.pop())
        if parts:
            yield from rows(*merged())
        yield from rows(np.array([-1]), np.array([size]))

    partial = docs.select(text, training).mapInArrow(count, "code long, n long")
    counts = written(partial.groupBy("code").agg(F.sum("n").alias("n")), "suffix-windows")
    size = counts.where("code = -1").agg(F.sum("n")).first()[0] or 0
    return counts.where("code >= 0"), size


@dataclass
class Automaton:
    """``step[state, symbol]`` is the next state, ``logp`` the log10 probability of the symbol there."""

    step: np.ndarray
    logp: np.ndarray
    symbol: np.ndarray  # column of each byte; bytes never read in training share one

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """log10 probability of each text."""
        read, starts = symbols(texts)
        if not len(read):
            return np.empty(0)
        column = self.symbol[read]
        rows = -(-len(column) // STRIDE)
        padded = np.full(DEPTH + rows * STRIDE, self.symbol[END])
        padded[DEPTH:DEPTH + len(column)] = column
        state = np.zeros(rows, np.int64)
        out = np.empty((STRIDE, rows))
        begin = np.arange(rows) * STRIDE
        for k in range(DEPTH + STRIDE):  # the first DEPTH symbols only lead to the state
            here = padded[begin + k]
            if k >= DEPTH:
                out[k - DEPTH] = self.logp[state, here]
            state = self.step[state, here]
        each = out.T.reshape(-1)[:len(column)]
        each[~_scored(starts)] = 0.0
        return np.add.reduceat(each, starts[:-1])


def tree_counts(counts: DataFrame) -> DataFrame:
    """(k, ctx, sym, c, n, kept) of all contexts seen LEAST times; ``kept`` ones are states.

    The divergence test: what the context's own distribution gains over its parent's, in nats, exceeds
    half the logarithm of its count for each of its next symbols (the description length of those).
    """
    code = F.col("code")
    level = counts.select("code", "n", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("k"))
    context = F.expr("CASE k " + " ".join(
        f"WHEN {k} THEN (code >> 8) & {(1 << 8 * k) - 1}L" for k in range(DEPTH + 1)) + " END")
    each = level.select("k", context.alias("ctx"), code.bitwiseAND(F.lit(255)).alias("sym"), "n") \
        .groupBy("k", "ctx", "sym").agg(F.sum("n").alias("c"))
    sums = Window.partitionBy("k", "ctx")
    each = written(
        each.withColumn("n", F.sum("c").over(sums)).where(F.col("n") >= LEAST), "suffix-contexts"
    )
    parent = each.select(
        (F.col("k") + 1).alias("k"), F.col("ctx").alias("up"), "sym", F.col("c").alias("pc"), F.col("n").alias("pn")
    )
    up = F.expr("CASE k " + " ".join(
        f"WHEN {k} THEN ctx & {(1 << 8 * max(0, k - 1)) - 1}L" for k in range(DEPTH + 1)) + " END")
    gain = F.col("c") * F.log((F.col("c") / F.col("n")) / (F.col("pc") / F.col("pn")))
    tested = each.withColumn("up", up).join(parent, ["k", "up", "sym"]).groupBy("k", "ctx") \
        .agg((F.sum(gain) > F.lit(0.5) * F.count("*") * F.log(F.first("n"))).alias("kept"))
    return each.join(tested, ["k", "ctx"], "left").select("k", "ctx", "sym", "c", "n", F.coalesce("kept", F.lit(False)).alias("kept"))


def build(counts: DataFrame) -> Automaton:
    """The whole tree as one automaton: for corpora that fit one process. ``score_texts`` does without it."""
    table = tree_counts(counts).where("kept OR k = 0").toArrow()
    k, ctx, sym, c = (table[name].to_numpy() for name in ("k", "ctx", "sym", "c"))
    kept = table["kept"].to_numpy(zero_copy_only=False)
    del table
    order = np.lexsort((ctx, k))
    k, ctx, sym, c, kept = k[order], ctx[order], sym[order], c[order], kept[order]
    starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (ctx[1:] != ctx[:-1])]) if len(k) else np.empty(0, np.int64)
    contexts = list(zip(k[starts].tolist(), ctx[starts].tolist()))
    own = dict(zip(contexts, map(slice, starts.tolist(), [*starts[1:].tolist(), len(k)])))
    chosen = {name for name, of in zip(contexts, kept[starts].tolist()) if of}
    # With all parts of a kept context the next state follows from the state alone.
    names = {(0, 0)}
    for depth, value in chosen:
        for length in range(1, depth + 1):
            for drop in range(depth - length + 1):
                names.add((length, (value >> 8 * drop) & ((1 << 8 * length) - 1)))
    names = sorted(names)
    number = {name: i for i, name in enumerate(names)}
    longer: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, (depth, value) in enumerate(names):
        if depth:
            longer.setdefault((depth - 1, value >> 8), []).append((value & 255, i))
    used = np.union1d(sym, [END]).astype(np.int64)
    symbol = np.full(SYMBOLS, len(used), np.int32)
    symbol[used] = np.arange(len(used))
    step = np.zeros((len(names), len(used) + 1), np.int32)
    prob = np.zeros((len(names), len(used) + 1), np.float32)
    for i, (depth, value) in enumerate(names):  # shorter contexts come first
        if not depth:
            found = np.zeros(len(used) + 1)
            rows = own.get((0, 0), slice(0, 0))
            found[symbol[sym[rows]]] = c[rows]
            prob[i] = (found + 1) / (found.sum() + SYMBOLS)
        else:
            shorter = number[depth - 1, value & ((1 << 8 * (depth - 1)) - 1)]
            step[i], prob[i] = step[shorter], prob[shorter]
            if (depth, value) in chosen:
                rows = own[depth, value]
                found = np.zeros(len(used) + 1)
                found[symbol[sym[rows]]] = c[rows]
                kinds = rows.stop - rows.start
                prob[i] = (found + kinds * prob[shorter]) / (found.sum() + kinds)
        for byte, target in longer.get((depth, value), ()):
            step[i, symbol[byte]] = target
    return Automaton(step, np.log10(prob, out=prob), symbol)
