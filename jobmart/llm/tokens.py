"""Token ids of whole texts by a public tokenizer file.

Both tokenizers never let a token reach from a word into the white space after it, so a text can be
cut there and equal pieces encoded once. The ids are those of the whole text; tests compare them.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np

#: The characters of Unicode's White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0            "
    "    　"
)

#: Pieces that are encoded in one go.
AT_ONCE = 64

#: White space belongs to the word after it: byte-level vocabularies, which keep white space.
LEADING_SPACE = f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+"

#: Such a piece with no white space but one blank before it.
ONE_SPACE = f" ?[^{WHITE_SPACE}]+"

#: White space is dropped and letters part from other characters: vocabularies with word ends. Letters that begin a
#: word are a piece of their own if ASCII punctuation follows, which nothing joins to them; a quote may (``'s``).
WORDS_ONLY = "[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[!-&(-/:-@\\[-`{-~])|[^\t\n\x0b\x0c\r ]+"
NO_BAR = "[^|]+"

#: A text without these may be lower-cased before a tokenizer that composes it (NFC) and lower-cases it itself:
#: no other character composes with one before it, or becomes several.
UNFOLDED = "[\\u0130\\u0300-\\U0010ffff]"


@dataclass(frozen=True)
class Encoding:
    """A tokenizer file, the pieces it may be cut into, the id that ends a document."""

    path: str
    pieces: str
    end_id: int
    #: Stands between pieces that are encoded in one go: one token, which shows where a piece ends.
    between: str
    #: What a piece looks like that no separator beside it can change.
    joins: str
    #: Pieces kept per worker; when more have been seen, the memory is emptied and filled anew.
    remembered: int = 1_200_000
    #: For tokenizers that lower-case: a text is lower-cased first, so that fewer pieces differ, unless it holds one of these.
    unfolded: str | None = None


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens."""

    def __init__(self, encoding: Encoding):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(encoding.path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cut = re.compile(encoding.pieces).findall
        self.end = np.uint32(encoding.end_id).astype("<u4").tobytes()
        self.remembered = encoding.remembered
        self.known: dict[str, bytes] = {}
        self.between = encoding.between
        self.joins = re.compile(encoding.joins).fullmatch
        self.unfolded = re.compile(encoding.unfolded).search if encoding.unfolded else None
        (self.between_id,) = self._ids(encoding.between)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces not seen before, many in one go; a piece that might run into the next goes alone."""
        joint = [p for p in pieces if self.joins(p)]
        if len(joint) < len(pieces):
            for piece in set(pieces).difference(joint):
                self.known[piece] = np.array(self._ids(piece), "<u4").tobytes()
        texts = [self.between.join(joint[at:at + AT_ONCE]) for at in range(0, len(joint), AT_ONCE)]
        flat: list[int] = []
        for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            flat += encoded.ids
            flat.append(self.between_id)
        ids = np.array(flat, "<u4")
        ends = (4 * np.flatnonzero(ids == self.between_id)).tolist()
        if len(ends) != len(joint):
            raise ValueError(f"{self.between!r} does not separate pieces")
        begins = [0, *(e + 4 for e in ends)]
        self.known.update(zip(joint, map(ids.tobytes().__getitem__, map(slice, begins, ends))))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Per text the bytes of its ids, the end id included; a missing text is an empty one."""
        if self.unfolded:
            texts = [t if not t or self.unfolded(t) else t.lower() for t in texts]
        cut = [self.cut(t) if t else [] for t in texts]
        if len(self.known) > self.remembered:
            self.known.clear()
        unseen = list(set().union(*cut).difference(self.known))
        if unseen:
            self._learn(unseen)
        ids = self.known.__getitem__
        return [b"".join(map(ids, pieces)) + self.end for pieces in cut]


_ENCODERS: dict[Encoding, Encoder] = {}


def encoder(encoding: Encoding) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if encoding not in _ENCODERS:
        _ENCODERS[encoding] = Encoder(encoding)
    return _ENCODERS[encoding]
