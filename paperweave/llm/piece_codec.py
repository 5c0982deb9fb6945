"""SentencePiece BPE ids of whole texts, and texts from ids.

A sequence of pieces is what the merges make of a text exactly if every two adjacent pieces
are what the merges make of those two alone. So a text is taken apart from left to
right, the longest piece first (all longest matches come from one Aho-Corasick pass); a piece that
doesn't stand beside the one before gives way to its longest prefix that is a piece, and a
position with no piece left is marked in a bitfield and never tried again.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, sliced
from .tokens import Recent

MARK = "▁"  # how pieces write a blank
CUTS = re.compile(r"\n|▁*[^▁\n]+|▁+")
STRETCHES, PAIRS = 300_000, 300_000  # bounds of a worker's caches
LONGEST = 64  # signs of a stretch that is remembered


class PieceCodec:
    """``encode(text)`` and ``decode(ids)`` of a BPE model, equal to the library's.

    The library gives the pieces and their scores only. Models that normalize texts beyond a
    leading blank (case, forms, several blanks), or have no byte pieces, are refused.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.byte_ids = {int(self.pieces[i][3:-1], 16): i for i in ids if model.is_byte(i)}
        odd = " A  ﬁ  "
        if len(self.byte_ids) != 256 or model.decode(model.encode(odd)) != odd or any(map(model.is_unused, ids)):
            raise ValueError("a BPE model with byte pieces, all pieces in use and texts left as they are is needed")
        self.silent = {i for i in ids if model.is_control(i)}
        self.unknown = {i for i in ids if model.is_unknown(i)}
        named = [i for i in ids if i not in self.silent | self.unknown and not model.is_byte(i)]
        self.ids = {self.pieces[i]: i for i in named}
        self.rank = {self.pieces[i]: -model.get_score(i) for i in named if len(self.pieces[i]) > 1}
        signs = {sign for piece in self.ids for sign in piece}
        self.halves = {p: made for p in self.rank if (made := self._last_merge(p))}
        found = sorted(signs | set(self.halves), key=len)
        self.matches = ahocorasick.Automaton()
        self.shorter: dict[str, str | None] = {}
        for piece in found:  # shorter ones come first
            self.shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.shorter), None)
            self.matches.add_word(piece, piece)
        self.matches.make_automaton()
        self.foreign = re.compile("([^" + "".join(map(re.escape, sorted(signs))) + "])")
        self.cuts = "\n" not in signs and not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.beside = Recent(self._stands_beside, PAIRS)
        self.known = Recent(self._stretch, STRETCHES)
        written = [self._surface(i) for i in ids]
        self.sizes = np.array([len(w) for w in written], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the merges join last to make a piece: best score first, the leftmost of equals."""
        parts, last = list(piece), 0.0
        while len(parts) > 1:
            ranks = [(rank, i) for i, pair in enumerate(zip(parts, parts[1:])) if (rank := self.rank.get(pair[0] + pair[1])) is not None]
            if not ranks or ranks[0][0] < last:
                return None  # the merges never make it
            last, at = min(ranks)
            pair = parts[at], parts[at + 1]
            parts[at : at + 2] = ["".join(pair)]
        return pair

    def _stands_beside(self, pair: tuple[str, str]) -> bool:
        """Whether the merges of two pieces' signs end in just these two: no merge across their border comes before one that they are made by.

        Takes back the merges next to the border, the last one first (of equal scores the right one).
        """
        left, right = pair
        before = float("inf")
        while True:
            across = self.rank.get(left + right)
            if across is not None and across < before:
                return False
            of_left, of_right = (self.rank[x] if len(x) > 1 else -1.0 for x in (left, right))
            if of_left > of_right:
                before, left = of_left, self.halves[left][1]
            elif of_right < 0:
                return True
            else:
                before, right = of_right + 0.5, self.halves[right][0]  # of equals the merge across stands further left

    def _taken_apart(self, text: str) -> list[str]:
        """Pieces of a text all of whose signs occur in pieces."""
        failed = bytearray(len(text) // 8 + 1)
        beside, shorter, length = self.beside, self.shorter, len(text)
        out: list[str] = []
        at, due, longest = 0, -1, iter(())
        before: str | None = None
        while at < length:
            if at != due:  # not where the longest match before ended
                longest = self.matches.iter_long(text, at)
            last, piece = next(longest)
            due = last + 1
            while True:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (before is None or beside[before, piece]):
                    out.append(piece)
                    at, before = end, piece
                    break
                piece = shorter[piece]
                while piece is None:  # nothing stands here: give the position up and shorten the piece before
                    failed[at >> 3] |= 1 << (at & 7)
                    at -= len(before)
                    piece = shorter[out.pop()]
                    before = out[-1] if out else None
        return out

    def _stretch(self, text: str) -> bytes:
        """Ids of a part of a text that no piece crosses the ends of."""
        ids: list[int] = []
        for k, part in enumerate(self.foreign.split(text)):
            for piece in [part] if k % 2 else self._taken_apart(part):
                known = self.ids.get(piece)
                if known is None:
                    ids.extend([self.byte_ids[b] for b in piece.encode()])
                else:
                    ids.append(known)
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers; none for an empty text."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        if not self.cuts:
            return self._stretch(marked)
        known = self.known
        return b"".join([known[part] if len(part) <= LONGEST else self._stretch(part) for part in CUTS.findall(marked)])

    def _surface(self, i: int) -> bytes:
        if i in self.silent:
            return b""
        if i in self.unknown:
            return " ⁇ ".encode()
        piece = self.pieces[i]
        return piece.replace(MARK, " ").encode() if piece in self.ids else bytes([int(piece[3:-1], 16)])

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: control ids are silent, a first piece loses its leading blank, bytes that are no UTF-8 become U+FFFD."""
        sizes = self.sizes[ids]
        shift = np.repeat(self.starts[ids] - np.cumsum(sizes) + sizes, sizes)
        whole = self.written[shift + np.arange(len(shift))].tobytes()
        first = next((i for i in ids.tolist() if i not in self.silent), None)
        blank = first is not None and first not in self.unknown and self.pieces[first].startswith(MARK)
        try:
            if sizes[1:-1].all():  # else a control id may part the bytes of a sign
                return whole[blank:].decode()
        except UnicodeDecodeError:
            pass
        return self._mended(ids.tolist())[blank:]

    def _mended(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            while run:
                n = 1 if run[0] < 0xC0 else 2 if run[0] < 0xE0 else 3 if run[0] < 0xF0 else 4
                try:
                    sign = run[:n].decode()
                except UnicodeDecodeError:
                    n, sign = 1, "�"
                out.append(sign)
                del run[:n]
            if i is not None:
                out.append(self._surface(i).decode())
        return "".join(out)


CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec for each worker and model; its caches outlive a task."""
    if path not in CODECS:
        CODECS[path] = PieceCodec(path)
    return CODECS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None) -> DataFrame:
    """``(doc_id, ids array<int>)`` for each row, with ``end_id`` after each text's ids where given.

    A null text counts as empty. Rows pass one by one: null and repeated ids, and rows that are
    equal, stay as many rows as they are. Texts of any length are encoded whole. An empty
    table gives an empty result; other columns are not read.
    """
    ship(docs.sparkSession)
    end = b"" if end_id is None else np.array([end_id], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in sliced(batches, 256):
            encoded = [own.encode(t.decode("utf-8", "replace") if t else "") + end for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(e) // 4 for e in encoded]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, ids, text)`` for each row; no ids, or null, give an empty text. An id outside the model fails the query."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in sliced(batches, 256):
            lists = batch.column(1)
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            texts = [own.decode(values[a:b]) if b > a else "" for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "id long, ids array<int>, text string").withColumnRenamed("id", id_col)
