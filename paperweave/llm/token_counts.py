"""Token counts by a map-side lookup in two tiers.

A text is cut where the tokenizer can never join pieces. Lengths of frequent pre-tokens come from a compact
table that all workers get; others are encoded once and remembered by the worker. Pre-tokens
are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows
from .tokens import Recent

MARK = "▁"
CUTS = re.compile(r"▁*[^▁\n]+|▁+|\n")
CACHE = 300_000
LONGEST = 256  # signs of a pre-token in the frequent table; longer ones are encoded where they stand


class PieceCounter:
    """Number of ids of a text for a sentencepiece model, without begin and end."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        self.cuts = not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
        one, two = len(self.model.encode("\n")), len(self.model.encode("\n\n"))
        self.line = two - one  # ids of a line end
        self.mark = one - self.line  # ids of a blank before a line end
        self.recent = Recent(self._count, CACHE)
        self.frequent: dict[str, int] = {}

    def _count(self, piece: str) -> int:
        """``piece`` is led by the sign for a blank, or by the line end before it, which counts too."""
        if piece[0] == MARK:
            return len(self.model.encode(piece[1:].replace(MARK, " "))) if len(piece) > 1 else self.mark
        return len(self.model.encode(piece)) - self.mark

    def pieces(self, text: str) -> list[str] | None:
        """Pre-tokens in order; None if the text must go whole."""
        if not self.cuts or MARK in text:
            return None
        text = MARK + text.replace(" ", MARK)
        out, line = [], False
        for piece in CUTS.findall(text):
            if piece == "\n":
                if line:
                    out.append("\n")
                line = True
                continue
            if line and piece[0] == MARK:
                out.append("\n")
            out.append("\n" + piece if line and piece[0] != MARK else piece)
            line = False
        return [*out, "\n"] if line else out

    def count(self, text: str) -> int:
        if not text:
            return 0
        pieces = self.pieces(text)
        if pieces is None:
            return len(self.model.encode(text))
        known = self.frequent.get
        recent = self.recent
        return sum([known(p) or recent[p] for p in pieces])


COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str, table=None) -> PieceCounter:
    """One counter for each worker and model; its cache outlives a task."""
    if path not in COUNTERS:
        COUNTERS[path] = PieceCounter(path)
    found = COUNTERS[path]
    if table is not None and not found.frequent:
        names, lengths = table.value
        found.frequent = dict(zip(names.split("\0"), lengths.tolist())) if names else {}
    return found


def frequent_pieces(docs: DataFrame, path: str, id_col: str, text_col: str, sample_rows: int, most: int) -> tuple[str, np.ndarray]:
    """The ``most`` frequent pre-tokens of about ``sample_rows`` documents, with their numbers of ids.

    It only decides what is looked up and what is encoded, never a count.
    """
    share = max(1, docs.count() // sample_rows)
    sample = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(share)) == 0).select(F.col(text_col).cast("binary"))

    def gather(rows):
        own, seen = counter(path), Counter()
        for (text,) in rows:
            seen.update(own.pieces(text.decode("utf-8", "replace")) or () if text else ())
            if len(seen) > 16 * most:
                seen = Counter(dict(seen.most_common(8 * most)))
        for piece, _ in seen.most_common(most):
            if "\0" not in piece and len(piece) <= LONGEST:
                yield piece, own.recent[piece]

    rows = map_rows(sample.repartition(1), gather, "piece string, n int").collect()  # at most `most` rows
    return "\0".join(r[0] for r in rows), np.array([r[1] for r in rows], np.uint32)


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 4000, most: int = 65_536
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for each row; a null text counts as empty, with 0 tokens."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, id_col, text_col, sample_rows, most))

    def counts(rows):
        own = counter(path, table)
        for identity, text in rows:
            yield identity, len(text or b""), own.count(text.decode("utf-8", "replace")) if text else 0

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_rows(texts, counts, "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
