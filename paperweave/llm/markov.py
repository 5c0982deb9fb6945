"""Byte context statistics: gathered over all rows by Spark, frozen into models of all contexts.

A model that outgrows one block is cut by the two bytes before a symbol: contexts of two and more bytes are in
one block, those of fewer in every block, so each gram is scored whole by one block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

WINDOW = 4 << 20
BLOCK = 1 << 19  # grams of all classes that a worker holds at once
HELD = 2  # blocks that stay loaded; of more, one at a time is


def grams(text: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` bytes and the byte after them, for each place of a text that follows ``order`` zeros."""
    n = len(text) - order
    codes = np.zeros(max(n, 0), np.uint64)
    for k in range(order + 1):
        codes = (codes << np.uint64(8)) | text[k : k + n]
    return codes


def windows(rows, order: int):
    """``(keys, places, bytes)`` of whole texts put together up to a bounded size.

    ``rows`` gives (key, bytes). Each text is led by ``order`` zeros; one longer than a window goes on in the
    next with its last bytes as lead. ``places`` are the starts of the texts' grams.
    """
    keys, parts, size = [], [], 0
    for key, text in rows:
        start = 0
        while True:
            part = text[start : start + WINDOW]
            lead = text[max(0, start - order) : start]
            keys.append(key)
            parts.append((bytes(order - len(lead)) + lead, part))
            size += len(part)
            start += WINDOW
            if size >= WINDOW:
                yield keys, parts
                keys, parts, size = [], [], 0
            if start >= len(text):
                break
    if keys:
        yield keys, parts


def codes_of(parts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all parts in a row, and how many each part has."""
    data = np.frombuffer(b"".join(x for p in parts for x in p), np.uint8)
    lengths = np.array([len(p[1]) for p in parts])
    codes = grams(data, order)
    ends = np.cumsum(lengths + order)
    inner = np.ones(len(data), bool)
    for k in range(order):  # grams whose symbol is a lead byte are none of a text
        inner[np.concatenate([[0], ends[:-1]]) + k] = False
    return codes[inner[order:]], lengths


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """``(class, gram, n)`` over all rows of ``texts(class, text)``; counted within tasks first."""

    def count(source):
        def rows():
            for batch in source:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield from zip(part.column(0).to_pylist(), (t or b"" for t in part.column(1).to_pylist()))

        for keys, parts in windows(rows(), order):
            for key in dict.fromkeys(keys):
                codes, _ = codes_of([p for k, p in zip(keys, parts) if k == key], order)
                found, n = np.unique(codes, return_counts=True)
                names = pa.array([key] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["class", "gram", "n"]
                )

    ship(texts.sparkSession)
    tall = texts.select(F.col("class").cast("string"), F.col("text").cast("binary"))
    return tall.mapInArrow(count, "class string, gram long, n long").groupBy("class", "gram").agg(F.sum("n").alias("n"))


class Models(dict):
    """Class by class its tree; of several blocks the first one's. ``blocks`` are ``(first, end, broadcast trees)``."""

    def __init__(self, names: list[str], order: int):
        super().__init__()
        self.names, self.order, self.blocks = names, order, []

    def scorer(self, method: str):
        """``bits_of(codes)`` for tasks: an array for each class, from whichever block has a code's contexts."""
        names, blocks = self.names, self.blocks

        def bits_of(codes: np.ndarray) -> np.ndarray:
            bits, part = np.zeros((len(names), len(codes))), _part(codes)
            for first, end, shared in blocks:
                at = np.flatnonzero((part >= first) & (part < end))
                if not len(at):
                    continue
                trees = shared.value
                for m, name in enumerate(names):
                    bits[m, at] = getattr(trees[name], method)(codes[at])
                if len(blocks) > HELD:
                    shared.__dict__.pop("_value", None)  # read again from its file when next asked for
            return bits

        return bits_of


def _part(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(8)) & np.uint64(0xFFFF)


def frozen(counts: DataFrame, order: int, max_grams: int | None = None, block_grams: int = BLOCK) -> Models:
    """A model for each class, of all grams counted, in blocks of about ``block_grams`` grams.

    With ``max_grams`` only the most frequent: each class has its share of the limit, what a small one leaves
    going to the others. A class's counts below the smallest bound that keeps to its share are left out, never
    its most frequent ones, so no class vanishes.
    """
    counts = stored(counts, "grams")
    if max_grams is not None:
        counts = _most_frequent(counts, max_grams)
    part = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    sizes = sorted(map(tuple, counts.groupBy(part.alias("part")).count().collect()))  # at most 65,536 rows
    names = sorted(r[0] for r in counts.select("class").distinct().collect())
    models, context = Models(names, order), counts.sparkSession.sparkContext
    starts, size = [0], 0
    for at, rows in sizes:
        if size and size + rows > block_grams:
            starts, size = [*starts, at], 0
        size += rows
    base = None
    if len(starts) > 1:  # grams of two bytes over all blocks: at most 65,536 rows a class
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * min(2, order + 1)) - 1))
        base = _by_class(counts.groupBy("class", low.alias("gram")).agg(F.sum("n").alias("n")), names)
    for first, end in zip(starts, [*starts[1:], 1 << 16]):
        own = _by_class(counts.filter((part >= first) & (part < end)), names)
        trees = {c: Contexts(*own[c], order, base and base[c]) for c in names}
        models.blocks.append((first, end, context.broadcast(trees)))
        if not models:
            models.update(trees)
    return models


def _by_class(counts: DataFrame, names: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """``(grams, counts)`` of each class."""
    number = F.array_position(F.array(*map(F.lit, names)), F.col("class")).cast("int") if names else F.lit(0)
    table = counts.select(number.alias("class"), "gram", F.col("n").cast("double")).toArrow()
    at, gram, n = (table.column(c).to_numpy() for c in table.column_names)
    return {c: (gram[at == k].view(np.uint64), n[at == k]) for k, c in enumerate(names, 1)}


def _most_frequent(counts: DataFrame, max_grams: int) -> DataFrame:
    level = F.floor(F.log2("n")).cast("int")
    rows = counts.groupBy("class", level.alias("level")).agg(F.count("*").alias("rows")).collect()  # 64 a class
    levels: dict[str, list[tuple[int, int]]] = {}
    for name, at, n in sorted(rows, key=lambda r: -r["level"]):
        levels.setdefault(name, []).append((at, n))
    bounds, left = [], max_grams
    smallest_first = sorted(levels, key=lambda c: (sum(n for _, n in levels[c]), c))
    for done, name in enumerate(smallest_first):
        kept, least = levels[name][0][1], levels[name][0][0]
        for at, n in levels[name][1:]:
            if kept + n > left // (len(levels) - done):
                break
            kept, least = kept + n, at
        bounds.append((name, least))
        left = max(0, left - kept)
    bound = counts.sparkSession.createDataFrame(bounds, "of string, least int")
    return counts.join(F.broadcast(bound), F.col("class") == F.col("of")).filter(level >= F.col("least")).drop("of", "least")


class Contexts:
    """Counts of all orders up to ``order``, each the sum over longer contexts.

    Of a block, ``base`` has the grams of two bytes of the whole class, from which its shortest contexts are.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, order: int, base: tuple[np.ndarray, np.ndarray] | None = None):
        self.order, self.levels = order, []
        for k in range(order, -1, -1):
            if base is not None and k == min(order, 1):
                gram, n = base
            low, at = np.unique(gram & self.mask(k + 1), return_inverse=True)
            gram, n = low, np.bincount(at, weights=n, minlength=len(low))
            context, of = np.unique(low >> np.uint64(8), return_inverse=True)
            total = np.bincount(of, weights=n, minlength=len(context))
            kinds = np.bincount(of, minlength=len(context)).astype(float)
            self.levels.append({"gram": low, "n": n, "context": context, "of": of, "total": total, "kinds": kinds})
        for k in range(order):  # what the shorter context has of the symbols that the longer one knows
            here, below = self.levels[k], self.levels[k + 1]
            at = np.searchsorted(below["gram"], here["gram"] & self.mask(order - k))
            here["covered"] = np.bincount(here["of"], weights=below["n"][at], minlength=len(here["context"]))

    @staticmethod
    def mask(size: int) -> np.uint64:
        return np.uint64((1 << (8 * size)) - 1)

    @staticmethod
    def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, values), len(table) - 1)
        return at, table[at] == values

    def ppm_bits(self, codes: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte: method C escapes, symbols of longer contexts excluded."""
        bits, done = np.zeros(len(codes)), np.zeros(len(codes), bool)
        less_total, less_kinds = np.zeros(len(codes)), np.zeros(len(codes))
        for k, level in enumerate(self.levels):
            if not len(level["gram"]):  # a block without longer contexts of this class
                continue
            low = codes & self.mask(self.order - k + 1)
            at, known = self._find(level["context"], low >> np.uint64(8))
            total, kinds = level["total"][at] - less_total, level["kinds"][at] - less_kinds
            g, seen = self._find(level["gram"], low)
            seen &= known & ~done
            bits[seen] += np.log2((total + kinds)[seen] / level["n"][g][seen])
            leave = known & ~done & ~seen & (kinds > 0)
            bits[leave] += np.log2(1 + total[leave] / kinds[leave])
            if "covered" in level:
                less_total = np.where(known, level["covered"][at], 0.0)
                less_kinds = np.where(known, level["kinds"][at], 0.0)
            done |= seen
        rest = ~done
        bits[rest] += np.log2(max(1.0, 256 - self.levels[-1]["kinds"].sum()))
        return bits

    def blended_bits(self, codes: np.ndarray) -> np.ndarray:
        """Minus log2 of the probability of each gram's last byte, orders blended by Witten and Bell's rule."""
        p = np.full(len(codes), 1 / 256)
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            if not len(level["gram"]):
                continue
            low = codes & self.mask(self.order - k + 1)
            at, known = self._find(level["context"], low >> np.uint64(8))
            g, seen = self._find(level["gram"], low)
            n = np.where(seen, level["n"][g], 0.0)
            p = np.where(known, (n + level["kinds"][at] * p) / (level["total"][at] + level["kinds"][at]), p)
        return -np.log2(p)


def text_bits(rows, order: int, bits_of):
    """``(key, bits per model, bytes)`` of whole texts, from ``bits_of(codes)`` giving an array per model.

    A text over several windows is summed up before it is given out.
    """
    last, sums, size = None, None, 0
    numbered = (((number, key), text) for number, (key, text) in enumerate(rows))
    for keys, parts in windows(numbered, order):
        codes, lengths = codes_of(parts, order)
        found, at = np.unique(codes, return_inverse=True)
        table = bits_of(found)
        starts, full = np.cumsum(lengths) - lengths, np.flatnonzero(lengths > 0)
        per = np.zeros((len(table), len(parts)))
        for m, bits in enumerate(table):
            if len(full):
                per[m, full] = np.add.reduceat(bits[at], starts[full])
        for j, key in enumerate(keys):
            if last is not None and last == key:
                sums, size = sums + per[:, j], size + int(lengths[j])
                continue
            if last is not None:
                yield last[1], sums, size
            last, sums, size = key, per[:, j], int(lengths[j])
    if last is not None:
        yield last[1], sums, size
