"""Token ids of whole texts through caches of the pieces that a tokenizer never joins.

A worker keeps the ids of each stretch between blanks it has met; only new ones reach the
tokenizer. Texts with signs on which the short cuts could differ go whole through
the library, so ids always equal its own.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import numpy as np
import regex

# The published split patterns of the two vocabularies.
BYTE_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
BLANKS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
LATIN = "ɐ"  # below it letters, digits and lower case are the same everywhere
CACHE = 500_000


def _byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


SIGNS = _byte_signs()


class Recent(dict):
    """A bounded cache in two generations: what was not used for a while is dropped."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.before = compute, limit, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """``encode(text)`` gives the ids as bytes of ``dtype``, equal to the library's with no special tokens added."""

    def __init__(self, path: str, cache: int | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.lowers = self.library.normalizer is not None
        self.bare = Recent(self._bare, cache or CACHE)  # stretches as they are
        self.led = Recent(lambda word: self._bare(" " + word), cache or CACHE)  # stretches after one blank

    def _bytes(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        led = piece[0] == " "
        rest = piece[1:] if led else piece
        if rest.isascii() and rest.isalnum():
            piece = SIGNS[32] + rest if led else rest
        else:
            piece = piece.encode().decode("latin-1").translate(SIGNS)
        return self._bytes([t.id for t in self.model.tokenize(piece)])

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.library.encode(text, add_special_tokens=False).ids)

    def _bare(self, text: str) -> bytes:
        if not text.isascii() and max(text) >= LATIN:
            return self._whole(text)
        if self.lowers:
            low = text.lower()
            if low.isalpha():
                return self._piece(low) if low == text else self.bare[low]
            pieces = WORD_LEVEL.findall(low)
            return self._piece(pieces[0]) if pieces == [text] else b"".join(map(self.bare.__getitem__, pieces))
        if (text[1:] if text[0] == " " else text).isalpha():
            return self._piece(text)
        pieces = BYTE_LEVEL.findall(text)
        if len(pieces) == 1:
            return self._piece(text)
        return b"".join(self.led[x[1:]] if x[0] == " " and len(x) > 1 and x[1] != " " else self.bare[x] for x in pieces)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special) or any(s in text for s in "\x1c\x1d\x1e\x1f"):
            return self._whole(text)
        words = text.split()
        if self.lowers:  # blanks only separate
            return b"".join(map(self.bare.__getitem__, words))
        lines = [line.split(" ") for line in text.split("\n")]
        if list(chain.from_iterable(lines)) != words:  # other blanks, or several in a row
            return b"".join(map(self.bare.__getitem__, BLANKS.findall(text)))
        parts, first, led, end = [], self.bare.__getitem__, self.led.__getitem__, self.bare["\n"]
        for line in lines:
            parts.append(first(line[0]))
            parts.extend(map(led, line[1:]))
            parts.append(end)
        return b"".join(parts[:-1])


ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, cache: int | None = None) -> Encoder:
    """One encoder for each worker and vocabulary; its caches outlive a task. ``cache`` bounds a generation of each cache."""
    if (path, cache) not in ENCODERS:
        ENCODERS[path, cache] = Encoder(path, cache)
    return ENCODERS[path, cache]
