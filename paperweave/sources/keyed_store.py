"""A table of keyed rows that later loads merge into.

Rows lie in buckets by the hash of their key. A load writes the rows it brings as one more version
of the buckets it touches and of no other; a read gives each key's versions to a merge function.
A bucket that has gathered ``most_versions`` of them is merged and written anew by the load that finds
it so. Which versions make up a bucket stands in a manifest of one row for each bucket, written
last: until then a load isn't seen, and a load that broke off is written over by the next one.
One load runs at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET, VERSION = "_bucket", "_version"


class KeyedStore:
    """``merge`` takes rows of any number of versions and returns one row for each key, with the same columns."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        merge: Callable[[DataFrame], DataFrame],
        buckets: int = 64,
        most_versions: int = 4,
    ):
        self.spark, self.path, self.keys, self.merge = spark, path.rstrip("/"), keys, merge
        self.buckets, self.most_versions = buckets, most_versions

    def manifest(self) -> tuple[int, dict[int, list[int]]]:
        """The last load's number (0 before the first) and the versions of each bucket; a row for each bucket is read."""
        try:
            rows = self.spark.read.parquet(f"{self.path}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return 0, {}
        last = rows.agg(F.max("load")).first()[0]
        found = rows.filter(F.col("load") == last).collect()
        if found and found[0]["of"] != self.buckets:
            raise ValueError(f"the store has {found[0]['of']} buckets")
        return last, {r["bucket"]: r["versions"] for r in found}

    def _rows(self, versions: dict[int, list[int]]) -> DataFrame | None:
        """Rows of the buckets as they were loaded."""
        paths = [f"{self.path}/rows/{VERSION}={v}/{BUCKET}={b}" for b, vs in sorted(versions.items()) for v in vs]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(*paths).drop(BUCKET, VERSION)

    def read(self) -> DataFrame | None:
        """One row for each key; None before the first load. Later loads don't change what it reads."""
        rows = self._rows(self.manifest()[1])
        return None if rows is None else self.merge(rows)

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def load(self, rows: DataFrame) -> list[int]:
        """Merge rows in; returns the touched buckets. Null keys are keys like others."""
        last, versions = self.manifest()
        number = last + 1
        own = f"{self.path}/rows/{VERSION}={number}"
        self._write(self.merge(rows), own)
        touched = [r[0] for r in self.spark.read.parquet(own).select(BUCKET).distinct().collect()] if self._any(own) else []
        full = {b: versions[b] for b in touched if len(versions.get(b, [])) >= self.most_versions}
        if full:
            number += 1
            before = self._rows({b: [*vs, last + 1] for b, vs in full.items()})
            self._write(self.merge(before), f"{self.path}/rows/{VERSION}={number}")
        now = versions | {b: [number] if b in full else [*versions.get(b, []), last + 1] for b in touched}
        entries = [(b, vs, self.buckets) for b, vs in sorted(now.items())]
        if entries:
            table = self.spark.createDataFrame(entries, "bucket int, versions array<int>, of int")
            table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/load={number}")
        return sorted(touched)

    def _write(self, rows: DataFrame, path: str) -> None:
        placed = rows.withColumn(BUCKET, self._bucket())
        placed.repartition(F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    def _any(self, path: str) -> bool:
        """Whether a version has rows: one without has no folder to infer columns from."""
        try:
            return BUCKET in self.spark.read.parquet(path).columns
        except AnalysisException as empty:
            if empty.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return False
