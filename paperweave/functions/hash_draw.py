"""Repeatable draws: the same seed and key give the same number on any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: str, key: Column, n: Column | int, round_no: Column | int | None = None) -> Column:
    """Integer in ``[0, n)`` from the md5 of ``seed:key[:round]`` (60 bits)."""
    parts = [F.lit(seed), key.cast("string")]
    if round_no is not None:
        parts.append((round_no if isinstance(round_no, Column) else F.lit(round_no)).cast("string"))
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")
    return F.pmod(bits, n if isinstance(n, Column) else F.lit(n))
