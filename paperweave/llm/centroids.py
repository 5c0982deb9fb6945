"""Nearest centroids by a vector-approximation file.

Every vector is written twice in one table: as a cell number of ``bits`` bits for each component, and in full. For
a round of centroids, lookup tables give the least and the largest product of a cell with a
centroid's component; with the vector's own squared length they give an interval for its
distance from each centroid. A vector whose nearest interval lies below all others is settled by its cells alone.

Between two rounds only vectors that aren't shown to stay where they are can change a centroid's
sum. So after the first round a round scans the cells only and fetches the other vectors
by their row; sums are carried on by what these add and take away. All sums are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, sliced, stored

LARGEST = 1 << 24  # components beyond are set to it, so that every distance fits a long
ROWS = 4096


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    start, end = column.offsets[0].as_py(), column.offsets[-1].as_py()
    return column.values[start:end].to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _packed(cells: np.ndarray, bits: int) -> list[bytes]:
    """``bits`` bits of each cell number, row by row."""
    low = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits :]
    return [row.tobytes() for row in np.packbits(low.reshape(len(cells), -1), axis=1)]


def _cells(batch: pa.RecordBatch, edges: np.ndarray) -> np.ndarray:
    """Cell numbers of a batch, a row for each vector."""
    column = batch.column(batch.schema.get_field_index("cells"))
    bits, width = (edges.shape[1] - 2).bit_length(), len(edges)
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    low = np.unpackbits(packed, axis=1)[:, : width * bits].reshape(len(packed), width, bits)
    whole = np.pad(low, ((0, 0), (0, 0), (8 - bits, 0)))
    return np.packbits(whole, axis=2)[:, :, 0]


class Bounds:
    """Distance intervals of vectors from centroids, given cells and squared lengths."""

    def __init__(self, edges: np.ndarray, centroids: np.ndarray):
        low, high = edges[:, :-1], edges[:, 1:] - 1  # a cell ends before the next one
        high[:, -1] += 1
        low, high = (x[:, :, None] * centroids.T[:, None] for x in (low, high))  # component, cell, centroid
        self.least, self.most = np.minimum(low, high), np.maximum(low, high)
        self.lengths = (centroids**2).sum(axis=1)
        self.at = np.arange(len(edges))

    def open(self, cells: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each vector, which centroids may be its nearest."""
        base = lengths[:, None] + self.lengths
        nearest, farthest = base.copy(), base.copy()
        for d in self.at:
            nearest -= 2 * self.most[d, cells[:, d]]
            farthest -= 2 * self.least[d, cells[:, d]]
        return nearest <= farthest.min(axis=1, keepdims=True)


def _settled(vectors: Callable, candidates: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector, the smaller number of equals; full vectors only where several are open."""
    found = candidates.argmax(axis=1)
    several = np.flatnonzero(candidates.sum(axis=1) > 1)
    if len(several):
        full, best = vectors(several), np.full(len(several), np.iinfo(np.int64).max)
        for c in np.flatnonzero(candidates[several].any(axis=0)):
            asks = np.flatnonzero(candidates[several, c])
            distance = ((full[asks] - centroids[c]) ** 2).sum(axis=1)
            closer = distance < best[asks]
            best[asks[closer]] = distance[closer]
            found[several[asks[closer]]] = c
    return found


def _sums(found: Iterator[tuple[np.ndarray, np.ndarray, int]], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """What the vectors of a task add to the centroids' counts and sums; components from 0, the count at -1."""
    totals = np.zeros((k, width + 1), np.int64)
    for clusters, vectors, sign in found:
        for c in np.unique(clusters):
            own = vectors[clusters == c]
            totals[c, 0] += sign * len(own)
            totals[c, 1:] += sign * own.sum(axis=0)
    cluster, part = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cluster, pa.int32()), pa.array(part - 1, pa.int32()), pa.array(totals[cluster, part])], names=["cluster", "part", "total"]
    )


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """``(vec_id, vector)`` of the rows with ``width`` finite components, each as floor(scale * component)."""
    given = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fit = "size(vector) = {0} and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))".format(width)
    limit = f"greatest(least(floor(x * {scale}D), {LARGEST}D), -{LARGEST}D)"
    return given.filter(fit).withColumn("vector", F.expr(f"transform(vector, x -> cast({limit} as int))"))


def cluster_vectors(
    rows: DataFrame,
    clusters: int = 16,
    rounds: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = 64,
    scale: int = 64,
    bits: int = 6,
    sample: int = 4096,
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` of every kept vector, and the final centroids (``clusters`` rows at most).

    Kept are vectors of ``width`` components, none null or non-finite, as floor(scale * component). The first centroids are
    those with the smallest SHA-256 of ``1:<vec_id>`` (equal ids: the smaller vector first; null ids last). A round
    moves each centroid that has vectors to the floor of their mean. Fewer vectors than ``clusters`` make as many
    centroids as there are. Null and repeated ids and equal rows stay rows of their own; ties go to the smaller centroid;
    components beyond 2^24 count as 2^24. An empty table gives an empty result. Other columns are not read.

    Cell edges are quantiles of the ``sample`` vectors that come first in the order of the first
    centroids; they decide only how tight the intervals are. The outermost edges come from all vectors.
    """
    ship(rows.sparkSession)
    spark = rows.sparkSession
    kept = stored(whole_vectors(rows, id_col, vector_col, width, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "vector").limit(max(sample, clusters)).select("vector").collect()
    if not first:
        return kept.select(F.col("vec_id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, width), np.int64)
    drawn = np.array([r[0] for r in first], np.int64)
    edges = _edges(kept, drawn, width, bits)
    fitted = spark.sparkContext.broadcast(edges)  # width * 2^bits numbers

    def approximate(batches):
        inner = fitted.value[:, 1:-1]
        for batch in sliced(batches, ROWS):
            vectors = _matrix(batch.column(1), width)
            cells = np.stack([np.searchsorted(inner[d], vectors[:, d], "right") for d in range(width)], axis=1).astype(np.uint8)
            extra = [pa.array(_packed(cells, bits), pa.binary()), pa.array((vectors**2).sum(axis=1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "cells", "length"])

    schema = "vec_id long, vector array<int>, row long, cells binary, length long"
    table = stored(kept.mapInArrow(approximate, schema), "approximations")

    centroids, k = drawn[:clusters], min(clusters, len(drawn))
    totals = np.zeros((k, width + 1), object)
    before = None
    for _ in range(rounds):
        moved = _first_sums(table, edges, centroids) if before is None else _moved_sums(table, edges, before, centroids)
        for cluster, part, total in moved.groupBy("cluster", "part").agg(F.sum("total")).collect():  # k * (width + 1) rows
            totals[cluster, part + 1] += total
        means = [[int(x) // int(row[0]) for x in row[1:]] if row[0] else old for row, old in zip(totals, centroids.tolist())]
        before, centroids = centroids, np.array(means, np.int64)
    return _assigned(table, edges, centroids).withColumnRenamed("vec_id", id_col), centroids


def _edges(kept: DataFrame, drawn: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Cell edges of each component: quantiles between the least and the largest value of all."""

    def extremes(batches):
        low, high = np.full(width, LARGEST), np.full(width, -LARGEST)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0), width)
                low, high = np.minimum(low, vectors.min(axis=0)), np.maximum(high, vectors.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    found = kept.select("vector").mapInArrow(extremes, "d int, low long, high long").groupBy("d").agg(F.min("low"), F.max("high"))
    ends = np.array(sorted(map(tuple, found.collect())))  # a row for each component
    inner = np.quantile(drawn, np.arange(1, 1 << bits) / (1 << bits), axis=0, method="nearest").T
    inner = np.clip(inner, ends[:, 1:2], ends[:, 2:3])
    return np.concatenate([ends[:, 1:2], inner, ends[:, 2:3]], axis=1)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _first_sums(table: DataFrame, edges: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Counts and sums of all vectors by their nearest centroid."""

    def run(batches):
        bounds = Bounds(edges, centroids)

        def found():
            for batch in sliced(batches, ROWS):
                vectors = _matrix(batch.column(0), len(edges))
                candidates = bounds.open(_cells(batch, edges), _column(batch, "length"))
                yield _settled(vectors.__getitem__, candidates, centroids), vectors, 1

        yield from _sums(found(), len(centroids), len(edges))

    return table.select("vector", "cells", "length").mapInArrow(run, "cluster int, part int, total long")


def _moved_sums(table: DataFrame, edges: np.ndarray, before: np.ndarray, now: np.ndarray) -> DataFrame:
    """What moving the centroids changes of counts and sums; only vectors that may have changed their centroid are fetched."""

    def unsure(batches):
        old, new = Bounds(edges, before), Bounds(edges, now)
        for batch in sliced(batches, ROWS):
            cells, lengths = _cells(batch, edges), _column(batch, "length")
            was, is_ = old.open(cells, lengths), new.open(cells, lengths)
            stays = (was.sum(axis=1) == 1) & (was == is_).all(axis=1)
            picked = pa.array(np.flatnonzero(~stays))
            both = [pa.array([row.tobytes() for row in x[~stays]], pa.binary()) for x in (was, is_)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), *both], names=["row", "was", "is"])

    asked = stored(table.select("row", "cells", "length").mapInArrow(unsure, "row long, was binary, is binary"), "asked")

    def run(batches):
        def found():
            for batch in sliced(batches, ROWS):
                vectors = _matrix(batch.column(0), len(edges))
                masks = [np.frombuffer(b"".join(batch.column(c).to_pylist()), bool).reshape(len(vectors), -1) for c in (1, 2)]
                old, new = (_settled(vectors.__getitem__, m, c) for m, c in zip(masks, (before, now)))
                changed = old != new
                yield old[changed], vectors[changed], -1
                yield new[changed], vectors[changed], 1

        yield from _sums(found(), len(now), len(edges))

    fetched = table.select("row", "vector").join(asked, "row").select("vector", "was", "is")
    return fetched.mapInArrow(run, "cluster int, part int, total long")


def _assigned(table: DataFrame, edges: np.ndarray, centroids: np.ndarray) -> DataFrame:
    def run(batches):
        bounds = Bounds(edges, centroids)
        for batch in sliced(batches, ROWS):
            vectors = _matrix(batch.column(1), len(edges))
            candidates = bounds.open(_cells(batch, edges), _column(batch, "length"))
            found = _settled(vectors.__getitem__, candidates, centroids)
            distance = ((vectors - centroids[found]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return table.select("vec_id", "vector", "cells", "length").mapInArrow(run, "vec_id long, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to ``(vec_id, cluster, distance)``."""
    assigned = stored(assigned, "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row for each cluster
    whole = (1 << 63) - 1
    of = {r["cluster"]: min(int(r["s"]), whole) for r in sums}
    facts = [(c, of.get(c, 0), min(sum(of.values()), whole), centroid_digest(v)) for c, v in enumerate(centroids)]
    table = assigned.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster")  # a row for each centroid
