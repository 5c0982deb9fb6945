"""Records of delimited text whose quoted fields hold line breaks, read in splits.

The text source cuts files into lines, wherever its splits begin. Each line is a step of an automaton of two
states, outside and inside of quotes: it leaves the state alone, turns it over, or sets it. The steps of a
split compose to one step, those of a file's splits give the state that each split starts in, and a line that
starts inside of quotes belongs to the last one before it that doesn't. So the lines are looked at in three
passes over the files and are never written or shuffled: the splits' steps, the parts of records
that go over the end of a split, and the records within splits.
"""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship, stored

_RANGE_BITS = 16  # lines looked at at a time, as a power of two
_BLANK = r"^[ \t\r]*$"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file`` (hash of the path), ``block``, ``value`` as bytes, in the order of the files."""
    # These functions cost a line less than the columns of _metadata do.
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(F.input_file_name()).alias("file"), F.call_function("input_file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


class _Lexer:
    """Whether lines end inside of quotes, for a start outside and inside. A quote counts at a field's beginning only."""

    def __init__(self, sep: str):
        self.sep = sep.encode()
        # No line holds a line feed, so it stands for a separator of several bytes.
        end = re.escape(sep) if len(self.sep) == 1 else r"\n"
        plain = rf'[^"{end}][^{end}]*'
        text = '(?:[^"]|"")*'
        fields = rf'(?:(?:"{text}"(?:{plain})?|(?:{plain})?){end})*'
        self.outside = rf'^{fields}"{text}$'
        self.inside = rf'^{text}(?:"(?:{plain})?{end}{fields}"{text})?$'

    def steps(self, lines) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow.compute as pc

        from0, from1 = np.zeros(len(lines), bool), np.ones(len(lines), bool)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        if len(quoted):
            some = lines if len(quoted) == len(lines) else lines.take(quoted)
            if len(self.sep) > 1:
                some = pc.replace_substring(some, self.sep, b"\n")
            from0[quoted] = pc.match_substring_regex(some, self.outside).to_numpy(zero_copy_only=False)
            from1[quoted] = pc.match_substring_regex(some, self.inside).to_numpy(zero_copy_only=False)
        return from0, from1


def _states(from0: np.ndarray, from1: np.ndarray, start: bool) -> np.ndarray:
    """Whether the place before each line, and the one after the last, is inside of quotes."""
    turned = np.concatenate([[0], np.cumsum(from0 & ~from1)])
    number = np.arange(1, len(from0) + 1)
    setter = np.maximum.accumulate(np.concatenate([[0], np.where(from0 == from1, number, 0)]))
    known = np.concatenate([[start], from0])
    return known[setter] ^ ((turned - turned[setter]) % 2 == 1)


def _runs(batches, most: int):
    """``(file, block), lines``: the lines of each batch, ``most`` at a time and cut where another split of a file begins."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            for start in range(a, b, most):
                yield (int(file[a]), int(block[a])), batch.column(2).slice(start, min(most, b - start))


def _blank(texts) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.match_substring_regex(texts, _BLANK).to_numpy(zero_copy_only=False)


def _split_steps(lexer: _Lexer):
    """One row a split: the states that it ends in for a start outside and inside, whether it
    comes inside from outside and outside from inside, whether it has a line that isn't blank."""

    most = 1 << _RANGE_BITS

    def walk(batches):
        import pyarrow as pa

        def row():
            return pa.RecordBatch.from_pydict(dict(zip(("file", "block", "to0", "to1", "opens", "leaves", "filled"), ([x] for x in (*at, *ends, opens, leaves, filled)))))

        at = None
        for place, lines in _runs(batches, most):
            if place != at:
                if at is not None:
                    yield row()
                at, ends, opens, leaves, filled = place, [False, True], False, False, False
            steps = lexer.steps(lines)
            walked = [_states(*steps, start) for start in ends]
            ends = [bool(w[-1]) for w in walked]
            opens, leaves = opens or bool(walked[0].any()), leaves or not walked[1][:-1].all()
            filled = filled or not _blank(lines).all()
        if at is not None:
            yield row()

    return walk


def _split_records(lexer: _Lexer, starts: dict, header: bool, parts: bool):
    """Records that lie within a split, or else (``parts``) those parts of records that don't.

    ``starts`` has of each split the state before it, the split that its open record began in, and
    whether it holds the file's first line that isn't blank.
    """

    most = 1 << _RANGE_BITS

    def walk(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def joined(pieces):
            texts = [x for piece in pieces for x in piece.to_pylist()]
            return b"\n".join(texts)

        def out(texts):
            return pa.RecordBatch.from_arrays([texts], names=["value"])

        def part():
            columns = [pa.array([x], kind) for x, kind in ((at[0], pa.int64()), (head, pa.int64()), (at[1], pa.int64()), (joined(held), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["file", "head", "block", "value"])

        def close(inside):
            """The end of the record in hand, at the next one's beginning or (``inside``: within it) at that of the next split."""
            nonlocal skip
            if not held or all(_blank(piece).all() for piece in held) and head is None:
                return
            if head is None and not inside:
                if skip:
                    skip = False
                elif not parts:
                    yield out(pa.array([joined(held)], pa.binary()))
            elif parts and not skip:
                yield part()

        at = None
        for place, lines in _runs(batches, most):
            if place != at:
                if at is not None:
                    head = at[1] if state and head is None else head
                    yield from close(state)
                if place not in starts:
                    raise ValueError("a file's splits changed between two passes: fix spark.sql.files.minPartitionNum")
                at, held = place, []
                state, head, skip = starts[at]
                skip = skip and header
            states = _states(*lexer.steps(lines), state)
            begins = np.flatnonzero(~states[:-1])
            if len(begins):
                first, last = int(begins[0]), int(begins[-1])
                if first:
                    held.append(lines.slice(0, first))
                yield from close(False)
                if last > first and not (parts and not skip):
                    inner = lines.slice(first, last - first)
                    bounds = pa.array(begins - first, pa.int32())
                    whole = pc.binary_join(pa.ListArray.from_arrays(bounds, inner), b"\n")
                    whole = whole.filter(pa.array(~_blank(whole)))
                    if skip and len(whole):
                        whole, skip = whole.slice(1), False
                    if len(whole) and not parts:
                        yield out(whole)
                held, head = [lines.slice(last)], None
            else:
                held.append(lines)
            state = bool(states[-1])
        if at is not None:
            head = at[1] if state and head is None else head
            yield from close(state)

    return walk


def _starts(steps: list) -> dict:
    """What ``_split_records`` needs, from the splits' steps: ``(file, block): (state, head, first)``."""
    starts = {}
    for _, splits in groupby(sorted(steps), lambda r: r["file"]):
        state, head, first = False, None, True
        for r in splits:
            starts[r["file"], r["block"]] = state, head if state else None, first and r["filled"]
            first = first and not r["filled"]
            head = r["block"] if not state or r["leaves"] else head
            state = r["to1"] if state else r["to0"]
        if state:
            raise ValueError(r["file"])
    return starts


def quoted_records(spark: SparkSession, path: str | list[str], sep: str = ",", header: bool = True) -> DataFrame | None:
    """``value``: the text of each record, line breaks inside of quotes kept; None if no record of any file goes over a line.

    Lines end with a line feed, a carriage return before it at a record's end is left out, one inside of quotes is kept.
    Lines without any sign but blanks are no records unless they stand inside of quotes. With ``header`` each
    file's first record is left out. A quote within an unquoted field is a sign like others.
    The files are read three times, and nothing of them is written but records that go over the end of a
    split. The driver holds a few numbers for each split, as it does to plan the read. All passes must cut the files alike, so
    ``spark.sql.files.minPartitionNum`` is set to the present parallelism where the session leaves it open.
    A file that ends inside of quotes is an error, found before any of its records is put together.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    if spark.read.option("lineSep", "\n").text(path).filter(F.col("value").contains('"')).isEmpty():
        return None
    ship(spark)
    lexer = _Lexer(sep)
    lines = _lines(spark, path)
    flags = "file long, block long, to0 boolean, to1 boolean, opens boolean, leaves boolean, filled boolean"
    steps = lines.mapInArrow(_split_steps(lexer), flags).collect()
    if not any(r["opens"] for r in steps):
        return None
    try:
        starts = _starts(steps)
    except ValueError as broken:
        named = spark.read.text(path).select(F.input_file_name().alias("name"))
        name = named.filter(F.xxhash64("name") == broken.args[0]).first()["name"]
        raise ValueError(f"{name} ends inside of quotes") from None

    records = lines.mapInArrow(_split_records(lexer, starts, header, False), "value binary")
    parts = lines.mapInArrow(_split_records(lexer, starts, header, True), "file long, head long, block long, value binary")
    parts = stored(parts, "quoted-parts")
    pieces = F.array_sort(F.collect_list(F.struct("block", F.col("value").cast("string").alias("value"))))
    # A group is one record, which is one row in the end. A header has lost its beginning.
    joined = parts.groupBy("file", "head").agg(F.min("block").alias("first"), F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"))
    found = records.select(F.col("value").cast("string").alias("value")).unionByName(joined.filter("first = head").select("value"))
    return found.select(_without_return("value"))


def _without_return(name: str) -> Column:
    text = F.col(name)
    return F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias(name)
