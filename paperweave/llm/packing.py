"""Packing of token pieces into sequences: patterns fitted by non-negative least squares.

Lengths are sorted into classes. All patterns of a few classes that fill a sequence are
listed, and the repeat counts whose sum comes nearest to the histogram of classes are found by
non-negative least squares and rounded. Pieces that no pattern takes, short ones
above all, go best-fit into the space that is left, and then into new sequences.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, ship, stored
from .tokens import encoder

SHARD_PIECES = 16_384
CLASSES = 32
PARTS = 4


def patterns(classes: int, parts: int) -> list[tuple[int, ...]]:
    """All ways to write ``classes`` as a sum of 2 to ``parts`` classes, largest first."""
    found: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int, most: int):
        if not left:
            found.append(chosen)
        elif len(chosen) < parts:
            for c in range(min(left, most), 0, -1):
                if c * (parts - len(chosen)) < left:
                    break
                extend((*chosen, c), left - c, c)

    extend((), classes, classes - 1)
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares by active sets."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        pull = np.where(active, -np.inf, a.T @ (b - a @ x))
        best = int(pull.argmax())
        if not len(pull) or pull[best] <= 1e-6 * max(1.0, np.abs(b).max()):
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            fit = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (fit > 0).all():
                x[:] = 0
                x[at] = fit
                break
            low = fit <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - fit[low], 1e-12))
            x[at] += step * (fit - x[at])
            drop = at[(x[at] <= 1e-9) | (low & (x[at] <= x[at][low].min() + 1e-9))]
            x[drop], active[drop] = 0, False
            if not active.any():
                break
    return x


def plan(lengths: np.ndarray, capacity: int, classes: int = CLASSES, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of each piece; no sequence holds more than ``capacity``."""
    sequence = np.full(len(lengths), -1, np.int64)
    offset = np.zeros(len(lengths), np.int64)
    unit = -(-capacity // classes)
    top = -(-capacity // unit)
    spare: list[int] = []  # free space of each open sequence
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # pieces by length
    for i in range(len(lengths) - 1, -1, -1):
        waiting[lengths[i]].append(i)
    there = sum(1 << n for n in range(capacity + 1) if waiting[n])  # bit n is set where pieces of length n wait
    have = np.bincount(-(-lengths // unit), minlength=top + 1)[1:].astype(float)

    def longest(most: int) -> int:
        return (there & ((2 << most) - 1)).bit_length() - 1

    def take(n: int, s: int):
        nonlocal there
        i = waiting[n].pop()
        if not waiting[n]:
            there &= ~(1 << n)
        sequence[i], offset[i] = s, capacity - spare[s]
        spare[s] -= n

    use = [p for p in patterns(top, parts) if all(have[c - 1] for c in p)]
    if use:
        a = np.zeros((top, len(use)))
        for k, p in enumerate(use):
            for c in p:
                a[c - 1, k] += 1
        weight = np.arange(1, top + 1) / top  # long pieces matter most: short ones find room anyway
        repeats = np.rint(nnls(a * weight[:, None], have * weight)).astype(int)
        for k in np.argsort(-repeats, kind="stable"):
            for _ in range(repeats[k]):
                space, chosen = capacity, []
                for place, c in enumerate(use[k]):
                    # the last piece is the one that fits best, so that classes cost no space
                    n = longest(space if place == len(use[k]) - 1 else c * unit)
                    if n <= (c - 1) * unit or len(waiting[n]) <= chosen.count(n):
                        break
                    chosen.append(n)
                    space -= n
                if len(chosen) < len(use[k]):
                    break
                spare.append(capacity)
                for n in chosen:
                    take(n, len(spare) - 1)

    open_by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0  # bit f is set where a sequence with f free places is open
    for s, f in enumerate(spare):
        open_by_space[f].append(s)
        filled |= 1 << f
    while there:
        size = there.bit_length() - 1
        fitting = filled >> size
        if fitting:
            f = size + (fitting & -fitting).bit_length() - 1
            s = open_by_space[f].pop()
            if not open_by_space[f]:
                filled &= ~(1 << f)
        else:
            spare.append(capacity)
            s = len(spare) - 1
        take(size, s)
        open_by_space[spare[s]].append(s)
        filled |= 1 << spare[s]
    return sequence, offset


def token_pieces(
    docs: DataFrame,
    path: str,
    end_id: int,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int | None = None,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the ids of each text, then ``end_id``, cut to ``capacity``.

    ``ids`` is little-endian unsigned 32-bit. A null text counts as empty: one piece with
    the end id alone. Every row has pieces of its own, also rows that repeat an id.
    ``words`` bounds a generation of a worker's cache: fewer take less memory and more time, ids are the same.
    """

    def pieces(rows):
        known = encoder(path, words)
        end = np.array([end_id], "<u4")
        for identity, text in rows:
            ids = np.frombuffer(known.encode(text.decode("utf-8", "replace") if text else ""), known.dtype)
            ids = np.concatenate([ids.astype("<u4"), end])
            for piece, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                yield identity, piece, start, len(part), part.tobytes()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_rows(texts, pieces, "id long, piece int, start long, length int, ids binary").withColumnRenamed("id", id_col)


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; other columns pass through.

    Pieces are dealt evenly to shards of about ``shard_pieces`` that are packed on their own, so a task holds a
    bounded number of lengths, and each shard can leave one sequence part empty. Lengths must be between 1 and
    ``capacity``; an empty table gives an empty one. Clashing columns ``sequence_id`` and ``offset`` are replaced,
    all others stay as they are.
    """
    ship(pieces.sparkSession)
    name = "_row"
    while name in pieces.columns:
        name += "_"
    pieces = pieces.drop("sequence_id", "offset").withColumn(name, F.monotonically_increasing_id())
    pieces = stored(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    lengths = pieces.select(name, F.col(length_col).cast("int").alias("n"), F.pmod(F.xxhash64(name), F.lit(shards)).alias("shard"))

    def shard(group):
        import pyarrow as pa

        row, n, number = (group.column(k).to_numpy() for k in range(3))
        order = np.argsort(row)
        row, n = row[order], n[order]
        sequence, offset = plan(n, capacity)
        return pa.table({name: row, "sequence_id": sequence + (int(number[0]) << 32), "offset": offset})

    placed = lengths.groupBy("shard").applyInArrow(shard, f"{name} long, sequence_id long, offset long")
    return pieces.join(placed, name).drop(name)
