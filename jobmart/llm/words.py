"""Words of whole texts, and their hashes, a batch of texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts one after another, A-Z lower-cased, and the row of each."""
    if texts.offset:  # Arrow lower-cases the wrong bytes of a slice after a cast
        texts = texts.take(pa.array(np.arange(len(texts))))
    lowered = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("").cast(pa.large_string())))
    split = pc.ascii_split_whitespace(lowered)
    flat, rows = split.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    real = pc.not_equal(flat, "")  # a text without words
    return flat.filter(real), rows[real.to_numpy(zero_copy_only=False)]


def hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return np.array([xxhash.xxh64_intdigest(w) for w in distinct.cast(pa.large_binary()).to_pylist()], np.uint64).astype(np.int64)


#: Bytes with A-Z lower-cased; all others, those of longer characters too, stay.
_LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def byte_set(*parts: int | range) -> np.ndarray:
    """For each byte whether it is among ``parts``."""
    chosen = np.zeros(256, bool)
    for part in parts:
        chosen[part if isinstance(part, int) else list(part)] = True
    return chosen


#: All of ASCII but letters and digits.
NO_LETTER_OR_DIGIT = byte_set(range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80))


def cut(texts: pa.Array, separators: np.ndarray, ends: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of all texts, the row of each, and the number of its piece, which grows from word to word.

    A-Z are lower-cased. ``separators`` are the bytes that part words, those of ``ends`` among them; a byte
    of ``ends`` starts another piece, and so does each text. NULL has no words.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    inside = ~separators[_LOWERED[raw]]
    first = np.zeros(len(raw) + 1, bool)
    first[at[:-1]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.int64)
    rows = np.searchsorted(at, starts, "right") - 1
    pieces = rows if ends is None else np.cumsum(ends[raw])[starts] + rows
    letters = _LOWERED[raw[inside]]
    offsets = np.append(np.cumsum(inside)[starts] - 1, len(letters))
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters))
    return flat, rows, pieces
