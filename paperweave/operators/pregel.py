"""Vertex-centric iteration that moves and writes changes only.

Edges are hash-partitioned and sorted once by ``src`` and cached.  The vertex
state is a base table, partitioned and sorted by ``id``, and the changes since
as small tables of the same layout: a round writes the vertices that accepted
a message, which are also the senders of the next round.  Only messages
(merged map-side) and changes are shuffled; joins merge sorted sides and can spill.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, keep, planned_shuffles, shuffle_partitions
from .skew import MIN_HOT_ROWS, hot_keys


# So many tables of changes of one level are merged into one of the next.
MERGE_RUNS = 4

# Counted rows of vertices that may be broadcast to their edges.
FEW_SOURCES = 20_000


class PartitionedEdges:
    """Edges laid out for repeated joins from their source side.

    A source holding more than its share of all edges is spread over several
    ``(src, slice)`` groups; ``fan_out`` then lists the slices of those few
    sources (at most one per shuffle partition).
    """

    def __init__(self, edges: DataFrame, min_hot_rows: int = MIN_HOT_ROWS):
        spark = edges.sparkSession
        parts = shuffle_partitions(spark)
        base = edges.filter("src IS NOT NULL AND dst IS NOT NULL").repartition(parts, "src")
        base = keep(base.sortWithinPartitions("src"))
        # The counting pass fills the cache, so it costs no extra read.
        hot = hot_keys(base, "src", min_hot_rows)
        self.fan_out = None
        self.edges = base
        if hot:
            share = max(min_hot_rows, base.count() // parts, 1)
            schema = T.StructType([edges.schema["src"], T.StructField("slices", T.IntegerType())])
            slices = spark.createDataFrame([(k, math.ceil(n / share)) for k, n in hot], schema)
            self.fan_out = F.broadcast(slices.withColumnRenamed("src", "id"))
            spread = F.pmod(F.xxhash64("dst"), F.coalesce("slices", F.lit(1))).cast("int")
            self.edges = keep(
                base.join(F.broadcast(slices), "src", "left")  # a row for each partition at most
                .withColumn("slice", spread)
                .drop("slices")
                .repartition(parts, "src", "slice")
                .sortWithinPartitions("src", "slice")
            )
            self.edges.count()
            base.unpersist()
        self._aliased = self.edges.alias("edge")
        self._on = F.col("src.id") == F.col("edge.src")
        if hot:
            self._on = self._on & (F.col("src.slice") == F.col("edge.slice"))

    def from_sources(self, sources: DataFrame, rows: int | None = None) -> DataFrame:
        """Join ``sources`` (alias ``src``) with their out-edges (alias ``edge``).

        ``rows`` is their counted number, if known: up to ``FEW_SOURCES`` are broadcast.
        """
        if self.fan_out is not None:
            slices = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
            sources = (
                sources.join(self.fan_out, "id", "left")
                .withColumn("slice", F.explode(slices))
                .drop("slices")
            )
        how = "broadcast" if rows is not None and rows <= FEW_SOURCES else "merge"
        return sources.alias("src").hint(how).join(self._aliased, self._on)

    def ends(self) -> DataFrame:
        """Distinct ids on either side; sources are made distinct where they lie."""
        sources = self.edges.select(F.col("src").alias("id")).distinct()
        return sources.union(self.edges.select("dst").distinct()).distinct()

    def release(self) -> None:
        self.edges.unpersist()


def _measured(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint ``df`` and count its rows.

    The cache gives the planner the measured size: estimates of joins multiply,
    and would go on multiplying from round to round.
    """
    cut = keep(cut_lineage(df))
    return cut, cut.count()


class VertexState:
    """The current row of every vertex: a base and, newest last, runs of changed rows. Of repeated ids one row stays.

    ``MERGE_RUNS`` runs of one level become one of the next, so a changed row is
    written again a logarithmic number of times; runs that together hold as
    many rows as there are vertices are folded into the base. ``written`` counts all rows written after the base.
    """

    def __init__(self, vertices: DataFrame):
        self.columns = vertices.columns
        self.schema = vertices.schema
        self.parts = shuffle_partitions(vertices.sparkSession)
        # A plan that AQE may change has no partitioning that a checkpoint could hand on: each round would shuffle the base again.
        with planned_shuffles(vertices.sparkSession):
            self.base, self.size = _measured(self._laid_out(vertices))
        self.runs: list[tuple[int, int, DataFrame]] = []  # level, rows, changed rows
        self.written = 0
        self.changes = 0

    def _laid_out(self, df: DataFrame) -> DataFrame:
        # A join's output stands in the order of ids of both sides, which a cache can't take over; a grouping's of one.
        return df.repartition(self.parts, "id").dropDuplicates(["id"]).sortWithinPartitions("id")

    def meet(self, merged: DataFrame) -> DataFrame:
        """``merged`` (one row an ``id``) with the current row of that vertex as ``state``; unknown ids are left out."""
        row = F.struct(*self.columns)
        met = merged.join(self.base.select("id", row.alias("_0")).hint("merge"), "id")
        for k, (_, _, run) in enumerate(self.runs, 1):
            met = met.join(run.select("id", row.alias(f"_{k}")).hint("merge"), "id", "left")
        names = [f"_{k}" for k in range(len(self.runs) + 1)]
        return met.withColumn("state", F.coalesce(*reversed(names))).drop(*names)

    def change(self, changed: DataFrame) -> tuple[DataFrame, int]:
        """Keep rows of changed vertices (one an ``id``, all columns); they are returned as stored, with their number."""
        laid_out = self._laid_out(changed.select([F.col(f.name).cast(f.dataType) for f in self.schema]))
        self.changes += 1
        if self.changes % MERGE_RUNS == 0:
            cut, rows = _measured(laid_out)
        else:
            seen = Observation()
            cut = cut_lineage(laid_out.observe(seen, F.count("*").alias("rows")))
            rows = seen.get["rows"]
        self.written += rows
        if rows:
            self.runs.append((0, rows, cut))
            self._compact()
        return cut, rows

    def _compact(self) -> None:
        if sum(rows for _, rows, _ in self.runs) >= self.size:
            old, self.base = self.base, _measured(self._laid_out(self.rows()))[0]
            self.written += self.size
            old.unpersist()
            self._forget(self.runs)
            self.runs = []
        while len(self.runs) >= MERGE_RUNS and self.runs[-MERGE_RUNS][0] == self.runs[-1][0]:
            level, last = self.runs[-1][0], self.runs[-MERGE_RUNS:]
            tagged = [df.withColumn("_at", F.lit(k)) for k, (_, _, df) in enumerate(last)]
            union = tagged[0]
            for df in tagged[1:]:
                union = union.unionByName(df)
            newest = F.max_by(F.struct(*self.columns), "_at").alias("row")
            cut, rows = _measured(self._laid_out(union.groupBy("id").agg(newest).select("row.*")))
            self.written += rows
            self._forget(last)
            self.runs[-MERGE_RUNS:] = [(level + 1, rows, cut)]

    @staticmethod
    def _forget(runs) -> None:
        # The newest run is still the frontier; its rows stay readable from the checkpoint.
        for _, _, df in runs[:-1]:
            df.unpersist()

    def rows(self) -> DataFrame:
        """All vertices as they are now."""
        row = F.struct(*self.columns)
        now = self.base.select("id", row.alias("_0"))
        for k, (_, _, run) in enumerate(self.runs, 1):
            now = now.join(run.select("id", row.alias(f"_{k}")).hint("merge"), "id", "left")
        names = [f"_{k}" for k in range(len(self.runs), -1, -1)]
        return now.select("id", F.coalesce(*names).alias("row")).select("row.*")

    def release(self) -> None:
        self.base.unpersist()
        for _, _, run in self.runs:
            run.unpersist()


def pregel(
    vertices: DataFrame,
    edges: DataFrame | PartitionedEdges,
    *,
    start: Column,
    message: Column,
    merge: Callable[[Column], Column],
    accept: Column,
    update: dict[str, Column],
    max_iter: int | None = None,
    trace: list[dict] | None = None,
) -> DataFrame:
    """Send, merge and update until no vertex accepts a message.

    ``start`` picks the vertices that send in round 1.  ``message`` is written
    over ``src.<state column>`` and ``edge.<edge column>``; null sends nothing.
    ``merge`` is an aggregate of the messages of one destination.  ``accept``
    and ``update`` are written over ``state.<column>`` and ``msg``; a vertex
    that accepts is updated and sends in the next round; its columns keep their
    types. ``trace`` gets the messages of each round and the rows written so far.
    """
    laid_out = edges if isinstance(edges, PartitionedEdges) else PartitionedEdges(edges)
    spark = vertices.sparkSession
    columns = vertices.columns
    state = VertexState(vertices)
    send = [F.col("edge.dst").alias("id"), message.alias("msg")]
    takes = F.coalesce(accept, F.lit(False))
    updated = [update[c].alias(c) if c in update else F.col(f"state.{c}").alias(c) for c in columns]
    frontier = state.base.filter(F.coalesce(start, F.lit(False)))
    live, rounds = frontier.count(), 0
    with planned_shuffles(spark):
        while live and (max_iter is None or rounds < max_iter):
            rounds += 1
            sent = laid_out.from_sources(frontier, live).select(*send).filter("msg IS NOT NULL")
            seen = Observation()
            if trace is not None:
                sent = sent.observe(seen, F.count("*").alias("messages"))
            merged = sent.groupBy("id").agg(merge(F.col("msg")).alias("msg"))
            before = frontier
            frontier, live = state.change(state.meet(merged).filter(takes).select(*updated))
            if all(before is not run for _, _, run in state.runs) and rounds > 1:
                before.unpersist()
            if trace is not None:
                trace.append({"messages": seen.get["messages"], "written": state.written})
        # Written once, so that neither the state's tables nor the edges have to stay cached.
        result = state.base if not state.runs else cut_lineage(state.rows())
    state.release()
    if not isinstance(edges, PartitionedEdges):
        laid_out.release()
    return result.select(columns)


def propagate_max(
    vertices: DataFrame, edges: DataFrame, value: str = "value", max_iter: int | None = None
) -> DataFrame:
    """Every vertex ends with the largest ``value`` that reaches it along edges."""
    return pregel(
        vertices.select("id", value),
        edges.select("src", "dst"),
        start=F.col(value).isNotNull(),
        message=F.col(f"src.{value}"),
        merge=F.max,
        accept=F.col(f"state.{value}").isNull() | (F.col("msg") > F.col(f"state.{value}")),
        update={value: F.col("msg")},
        max_iter=max_iter,
    )


def graph_max_value(vertices: DataFrame, value: str = "value") -> DataFrame:
    """One row: the maximum over all vertices, which propagation cannot change."""
    return vertices.agg(F.max(value).alias("max_value"))
