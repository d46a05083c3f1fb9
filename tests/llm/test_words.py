import re

import numpy as np
import pyarrow as pa

from jobmart.llm.words import NO_LETTER_OR_DIGIT, byte_set, cut
from tests.llm.conftest import prose

TEXTS = ["One two-three, FOUR. Ünï 漢字x\x00 5", None, "", " .,", "ends", "Starts\nmid\tdle;end", "a", prose(3, 3000)]
ENDS = byte_set(*map(ord, ".,;:!?"), range(0x0A, 0x0E))


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_same_as_regular_expressions():
    array = pa.array(TEXTS)
    for texts, given in ((TEXTS, array), (TEXTS[3:], array.slice(3)), (TEXTS[1:6], array.slice(1, 5))):
        flat, rows, _ = cut(given, NO_LETTER_OR_DIGIT)
        want = [(k, w) for k, t in enumerate(texts) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))]
        assert list(zip(rows.tolist(), flat.to_pylist())) == want
        flat, rows, pieces = cut(given, ENDS | byte_set(0x20, 0x09), ENDS)
        want = [
            (k, p, w) for k, t in enumerate(texts) for p, piece in enumerate(re.split(r"[.,;:!?\x0A-\x0D]", lowered(t)))
            for w in re.findall(r"[^\x20\x09]+", piece)
        ]
        assert list(zip(rows.tolist(), flat.to_pylist())) == [(k, w) for k, _, w in want]
        same = [(a[:2] == b[:2]) for a, b in zip(want, want[1:])]
        assert (np.diff(pieces) == 0).tolist() == same


def test_nothing():
    for texts in ([], [None], ["", " "]):
        flat, rows, pieces = cut(pa.array(texts, pa.string()), NO_LETTER_OR_DIGIT)
        assert len(flat) == len(rows) == len(pieces) == 0
