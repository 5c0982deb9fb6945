"""Hot-key handling for joins that AQE cannot split (cached, co-partitioned sides)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions

# Below this many rows a key is cheap for one task whatever its share.
MIN_HOT_ROWS = 200_000

# Hashes that keys are counted by first, for each partition.
_HASHES = 16


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS) -> list[tuple]:
    """``(key, rows)`` of every key that holds more than one partition's fair share.

    With P shuffle partitions the share is 1/P of all rows, so at most P keys
    can qualify: the list on the driver is bounded by the partition count,
    never by the data. A hot key shows in the count of its hash, so most tables need no count by key.
    """
    parts = shuffle_partitions(df.sparkSession)
    place = F.pmod(F.xxhash64(key), F.lit(parts * _HASHES))
    by_hash = df.groupBy(place.alias("h")).agg(F.count("*").alias("rows"), F.count(key).alias("known")).collect()
    least = max(min_rows, sum(r["rows"] for r in by_hash) / parts)
    heavy = [r["h"] for r in by_hash if r["known"] > least]
    if not heavy:
        return []
    counts = df.filter(F.col(key).isNotNull() & place.isin(heavy)).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"))
    top = counts.filter(F.col("rows") > least).orderBy(F.desc("rows")).limit(parts)
    return [(r["key"], r["rows"]) for r in top.collect()]


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join ``facts`` to ``dimension`` (unique on ``key``) with hot keys split off.

    Rows of hot keys meet a broadcast of at most P dimension rows and never
    move; all other rows take the ordinary shuffled join.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup keeps or drops fact rows: use 'inner' or 'left'")
    hot = [value for value, _ in hot_keys(facts, key, min_rows)]
    if not hot:
        return facts.join(dimension, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = F.broadcast(dimension.filter(F.col(key).isin(hot)))
    return (
        facts.filter(~is_hot)
        .join(dimension, key, how)
        .unionByName(facts.filter(is_hot).join(few, key, how))
    )
