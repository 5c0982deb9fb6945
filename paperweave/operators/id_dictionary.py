"""Ids of values that stay the same from one load of a dump to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.keyed_store import KeyedStore
from .entities import dense_ids


class IdDictionary:
    """``value, node_id`` kept in a folder. Values that a load brings for the first time get the next ids, in value order."""

    def __init__(self, spark: SparkSession, path: str, start: int = 0, buckets: int = 64):
        # A value is only ever loaded once, so versions of a bucket have no key in common.
        self.store = KeyedStore(spark, path, ["value"], lambda rows: rows, buckets)
        self.start = start

    def read(self) -> DataFrame | None:
        return self.store.read()

    def next_id(self) -> int:
        """After the largest id given so far."""
        known = self.read()
        last = known.agg(F.max("node_id")).first()[0] if known is not None else None
        return self.start if last is None else last + 1

    def extend(self, values: DataFrame, value: str = "value", start: int | None = None) -> DataFrame:
        """Adds the values that are new, null left out, and returns the whole dictionary.

        ``start`` lets the ids go on after others given meanwhile, such as ids of records; an id is never given twice.
        """
        asked = values.select(F.col(value).alias("value")).dropna().distinct()
        known = self.read()
        if known is not None:
            asked = asked.join(known.select("value"), "value", "left_anti")
        new = cut_lineage(asked)
        self.store.load(dense_ids(new, ["value"], "node_id", max(self.next_id(), start or 0)))
        found = self.read()
        return found if found is not None else new.withColumn("node_id", F.lit(None).cast("long"))

    def edges(self, pairs: DataFrame, record_id: str, value: str = "value") -> DataFrame:
        """``start_id, end_id`` from records to the ids of their values, each pair once."""
        rows = pairs.select(F.col(record_id).alias("start_id"), F.col(value).alias("value")).dropna().distinct()
        return rows.join(self.read(), "value").select("start_id", F.col("node_id").alias("end_id"))
