"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of the last 32 bytes says so, and becomes a recipe: the
ordered hashes of its chunks. Recipes, not texts, are compared. Chunks of texts
whose recipes meet are moved once to see whether a hash stands for one content; a hash that stands
for several is told apart by the number of the content, so equal recipes of
verified identifiers mean equal texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, stored

GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)
SEEN = 50_000


def cut(data: bytes, mask_bits: int, least: int, most: int) -> list[bytes]:
    """Content-defined chunks: about ``2**mask_bits`` bytes, between ``least`` and ``most``."""
    size = len(data)
    if size <= least:
        return [data] if size else []
    rolled = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        before = rolled[:-step] << np.uint32(step)
        rolled = rolled.copy()
        rolled[step:] += before
    marks = np.flatnonzero((rolled >> np.uint32(32 - mask_bits)) == 0) + 1
    ends, start = [], 0
    for mark in [*marks.tolist(), size]:
        while mark - start > most:
            start += most
            ends.append(start)
        if mark - start >= least or mark == size > start:
            start = mark
            ends.append(mark)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _hash(chunk: bytes, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(chunk) % (1 << bits) - (1 << (bits - 1))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mask_bits: int = 10,
    least: int = 256,
    most: int = 8192,
    hash_bits: int = 64,
) -> DataFrame:
    """One row ``(doc_id, keep_id, group_size, kept, text_sha256)`` per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with the largest id
    stays. Null text counts as empty. A null id is smaller than any id: such a row stays only
    where no row of its group has an id. Rows that repeat id and text count
    in ``group_size`` and share ``kept``. ``hash_bits`` below 64 is for testing collisions.
    """

    def recipe(rows):
        for identity, text in rows:
            plain = (text or b"").lower()
            yield identity, hashlib.sha256(plain).hexdigest(), [_hash(c, hash_bits) for c in cut(plain, mask_bits, least, most)]

    def chunks(rows):
        seen = {}
        for _, text in rows:
            for chunk in cut((text or b"").lower(), mask_bits, least, most):
                key = _hash(chunk, hash_bits)
                if seen.get(key) != chunk:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[key] = chunk
                    yield key, chunk

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    recipes = stored(map_rows(texts, recipe, "id long, sha string, recipe array<long>"), "recipes")
    shared = stored(recipes.groupBy("recipe").count().filter("count > 1").select("recipe"), "shared")
    suspects = recipes.join(shared, "recipe", "left_semi")
    ids = stored(suspects.select(F.col("id").alias("suspect")).distinct(), "suspects")
    again = texts.join(ids, F.col("id").eqNullSafe(F.col("suspect")), "left_semi")
    contents = map_rows(again, chunks, "hash long, chunk binary").distinct()
    double = stored(contents.groupBy("hash").count().filter("count > 1").select("hash"), "collisions")
    if double.isEmpty():
        known = recipes.withColumn("variants", F.lit(None).cast("array<long>"))
    else:
        known = _told_apart(recipes, again, double, lambda data: cut(data, mask_bits, least, most), hash_bits)

    key = F.struct("recipe", F.coalesce("variants", F.array().cast("array<long>")).alias("variants"))
    known = known.select("id", "sha", key.alias("recipe"))
    groups = known.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count("*").alias("rows"))
    groups = stored(groups.filter("rows > 1"), "groups")
    kept = F.coalesce("keep_id", "id")
    return known.join(groups, "recipe", "left").select(
        F.col("id").alias(id_col),
        kept.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).alias("group_size"),
        F.col("id").eqNullSafe(kept).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _told_apart(recipes: DataFrame, texts: DataFrame, double: DataFrame, cutter, hash_bits: int) -> DataFrame:
    """Adds, for the chunks whose hash stands for several contents, the number of their content."""

    def occurrences(rows):
        for identity, text in rows:
            plain = (text or b"").lower()
            sha = hashlib.sha256(plain).hexdigest()
            for place, chunk in enumerate(cutter(plain)):
                yield identity, sha, place, _hash(chunk, hash_bits), chunk

    found = map_rows(texts, occurrences, "id long, sha string, place int, hash long, chunk binary")
    found = stored(found.join(double, "hash", "left_semi").distinct(), "colliding")
    contents = found.select("hash", "chunk").distinct()
    number = F.row_number().over(Window.partitionBy("hash").orderBy("chunk")).cast("long")
    numbered = stored(contents.withColumn("number", number), "numbered")
    lists = found.join(numbered, ["hash", "chunk"]).groupBy("id", "sha").agg(
        F.sort_array(F.collect_list(F.struct("place", "number"))).alias("list")
    )
    lists = lists.select(F.col("id").alias("of"), F.col("sha").alias("of_sha"), F.col("list.number").alias("variants"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("of_sha"))
    return recipes.join(lists, same, "left").select("id", "sha", "recipe", "variants")
