"""Single-source shortest costs and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, keep, planned_shuffles
from .graph import endpoints
from .pregel import PartitionedEdges, VertexState, pregel
from .skew import lookup


def _check_weights(edges: DataFrame, weight: str, max_iter: int | None) -> None:
    if max_iter is None:
        lowest = edges.agg(F.min(weight)).first()[0]
        if lowest is not None and lowest < 0:
            raise ValueError("negative weights need max_iter: a negative cycle never converges")


def _cost_type(edges: DataFrame, weight: str) -> T.DataType:
    """The type costs are summed and compared in: as wide as the weights' kind allows."""
    kind = edges.schema[weight].dataType
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, T.FractionalType):
        return T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.DoubleType()
    raise TypeError(f"weights must be numbers, not {kind.simpleString()}")


def shortest_costs(
    edges: DataFrame,
    source,
    weight: str = "weight",
    vertices: DataFrame | None = None,
    max_iter: int | None = None,
    trace: list[dict] | None = None,
) -> DataFrame:
    """``id, dist``: cheapest cost from ``source``; null where it cannot reach.

    Costs keep the kind of the weights: whole, decimal or floating. ``trace`` is ``pregel``'s.
    """
    kind = _cost_type(edges, weight)
    laid_out = PartitionedEdges(edges.select("src", "dst", F.col(weight).cast(kind).alias("w")))
    _check_weights(laid_out.edges, "w", max_iter)
    ids = vertices.select("id").distinct() if vertices is not None else laid_out.ends()
    is_source = F.col("id") == F.lit(source)
    found = pregel(
        ids.select("id", F.when(is_source, F.lit(0)).cast(kind).alias("dist")),
        laid_out,
        start=is_source,
        message=(F.col("src.dist") + F.col("edge.w")).cast(kind),
        merge=F.min,
        accept=F.col("state.dist").isNull() | (F.col("msg") < F.col("state.dist")),
        update={"dist": F.col("msg")},
        max_iter=max_iter,
        trace=trace,
    )
    laid_out.release()
    return found


def shortest_costs_by_bucket(
    edges: DataFrame,
    source,
    weight: str = "weight",
    vertices: DataFrame | None = None,
    width=None,
    trace: list[dict] | None = None,
) -> DataFrame:
    """``id, dist`` as ``shortest_costs`` gives them, settled one range of costs after another.

    Costs fall into buckets of ``width`` (by default four times the mean weight; each bucket takes some rounds). Within the lowest open bucket
    only edges of at most ``width`` are followed, until none of its vertices improves; then each of them sends along its dearer
    edges, once. So a vertex that many rounds improve does not send its dear edges in each of them.
    Weights must not be negative; edges without a weight are left out. An unknown ``source`` reaches nothing.
    """
    kind = _cost_type(edges, weight)
    weighted = edges.select("src", "dst", F.col(weight).cast(kind).alias("w")).filter("w IS NOT NULL")
    least, mean = weighted.agg(F.min("w"), F.avg("w")).first()
    if least is not None and least < 0:
        raise ValueError("buckets need weights that are not negative")
    width = (4 * mean if mean else 1) if width is None else width
    if width <= 0:
        raise ValueError("width must be above 0")
    light = PartitionedEdges(weighted.filter(F.col("w") <= F.lit(width)))
    dear = PartitionedEdges(weighted.filter(F.col("w") > F.lit(width)))
    if vertices is None:
        left_out = edges.filter(F.col(weight).cast(kind).isNull() | F.col("src").isNull() | F.col("dst").isNull())
        vertices = light.ends().union(dear.ends()).union(endpoints(left_out))
    ids = vertices.select("id").distinct()
    is_source = F.col("id") == F.lit(source)
    bucket = F.floor(F.col("dist") / F.lit(width)).cast("long")
    state = VertexState(
        ids.select("id", F.when(is_source, F.lit(0)).cast(kind).alias("dist"), F.lit(0).cast("long").alias("bucket"))
    )
    #: Changed vertices by the rounds that found them; rows of later buckets wait there.
    waiting: list[DataFrame] = []

    def relax(along: PartitionedEdges, senders: DataFrame, least_bucket: int) -> tuple[DataFrame, int]:
        sent = along.from_sources(senders).select(
            F.col("edge.dst").alias("id"), (F.col("src.dist") + F.col("edge.w")).cast(kind).alias("dist")
        )
        seen = Observation()
        if trace is not None:
            sent = sent.observe(seen, F.count("*").alias("messages"))
        better = (
            state.meet(sent.groupBy("id").agg(F.min("dist").alias("dist")))
            .filter(F.col("state.dist").isNull() | (F.col("dist") < F.col("state.dist")))
            .select("state.id", "dist", F.greatest(bucket, F.lit(least_bucket)).alias("bucket"))
        )
        changed, rows = state.change(better)
        if trace is not None:
            trace.append({"messages": seen.get["messages"], "written": state.written})
        if rows:
            waiting.append(changed)
        return changed, rows

    def open_rows(least_bucket: int) -> DataFrame:
        rows = waiting[0]
        for more in waiting[1:]:
            rows = rows.unionByName(more)
        return rows.filter(F.col("bucket") >= least_bucket)

    with planned_shuffles(edges.sparkSession):
        now, senders = 0, state.base.filter(is_source)
        while now is not None:
            settled, rows = senders, 1
            while rows:
                changed, rows = relax(light, senders, now)
                senders = changed.filter(F.col("bucket") == now)
                if rows:
                    settled = settled.unionByName(senders)
            # A vertex that improved within its bucket stands there more than once.
            relax(dear, settled.groupBy("id").agg(F.min("dist").alias("dist")), now + 1)
            waiting = _still_open(waiting, now + 1)
            now = open_rows(now + 1).agg(F.min("bucket")).first()[0] if waiting else None
            if now is not None:
                waits = open_rows(now).filter(F.col("bucket") == now).groupBy("id").agg(F.min("dist").alias("dist"))
                # Of a vertex that has moved on to a lower cost since, an old row is left out.
                senders = (
                    state.meet(waits).filter(F.col("dist") == F.col("state.dist")).select("state.id", "dist", F.lit(now).alias("bucket"))
                )
        result = cut_lineage(state.rows().select("id", "dist"))
    state.release()
    light.release()
    dear.release()
    return result


def _still_open(waiting: list[DataFrame], least_bucket: int) -> list[DataFrame]:
    """Of the tables of changed vertices those with rows that still wait."""
    if not waiting:
        return []
    tagged = [df.select(F.lit(k).alias("k"), "bucket") for k, df in enumerate(waiting)]
    rows = tagged[0]
    for more in tagged[1:]:
        rows = rows.unionByName(more)
    left = rows.groupBy("k").agg(F.max("bucket").alias("last")).filter(F.col("last") >= least_bucket).select("k")
    return [waiting[r["k"]] for r in left.collect()]


def shortest_paths(
    edges: DataFrame,
    source,
    weight: str = "weight",
    vertices: DataFrame | None = None,
    max_iter: int | None = None,
) -> DataFrame:
    """``id, dist, path``: cheapest cost, and the vertices from ``source`` to ``id``.

    Among equally cheap paths the one with the fewest edges wins, then the one
    whose last-but-one vertex id is smallest.  Costs and hop counts come from
    one Pregel run that orders messages by (cost, hops); hops grow along every
    parent link, so zero-weight edges cannot close a cycle.  Paths are then
    assembled by pointer doubling, in log2(longest path) joins.
    """
    kind = _cost_type(edges, weight)
    laid_out = PartitionedEdges(edges.select("src", "dst", F.col(weight).cast(kind).alias("w")))
    _check_weights(laid_out.edges, "w", max_iter)
    ids = vertices.select("id").distinct() if vertices is not None else laid_out.ends()
    is_source = F.col("id") == F.lit(source)
    zero = F.when(is_source, F.lit(0))
    better = (F.col("msg.dist") < F.col("state.dist")) | (
        (F.col("msg.dist") == F.col("state.dist")) & (F.col("msg.hops") < F.col("state.hops"))
    )
    step = F.struct(
        (F.col("src.dist") + F.col("edge.w")).cast(kind).alias("dist"), (F.col("src.hops") + 1).alias("hops")
    )
    state = keep(
        pregel(
            ids.select("id", zero.cast(kind).alias("dist"), zero.cast("long").alias("hops")),
            laid_out,
            start=is_source,
            message=step,
            merge=F.min,
            accept=F.col("state.dist").isNull() | better,
            update={"dist": F.col("msg.dist"), "hops": F.col("msg.hops")},
            max_iter=max_iter,
        )
    )
    # One more send along all reached edges names each vertex's parent.
    offer = (
        laid_out.from_sources(state.filter("dist IS NOT NULL"))
        .select(
            F.col("edge.dst").alias("id"),
            F.struct(
                (F.col("src.dist") + F.col("edge.w")).cast(kind).alias("dist"),
                (F.col("src.hops") + 1).alias("hops"),
                F.col("src.id").alias("parent"),
            ).alias("offer"),
        )
        .groupBy("id")
        .agg(F.min("offer").alias("offer"))
    )
    rooted = state.join(offer, "id", "left").select(
        "id",
        "dist",
        F.when(F.col("hops") > 0, F.col("offer.parent")).alias("up"),
        F.when(F.col("dist").isNotNull(), F.array("id")).alias("path"),
    )
    paths = _assemble(cut_lineage(rooted))
    state.unpersist()
    laid_out.release()
    return paths


def _assemble(rooted: DataFrame) -> DataFrame:
    """Replace ``up`` by its own ``up`` and prepend its segment until none is left."""
    current = keep(rooted)
    open_rows = current.filter("up IS NOT NULL").count()
    while open_rows:
        above = current.select(
            F.col("id").alias("up"), F.col("up").alias("up2"), F.col("path").alias("head")
        ).filter("head IS NOT NULL")
        grown = lookup(current.filter("up IS NOT NULL"), above, "up").select(
            "id", "dist", F.col("up2").alias("up"), F.concat("head", "path").alias("path")
        )
        stepped = keep(cut_lineage(current.filter("up IS NULL").unionByName(grown)))
        open_rows = stepped.filter("up IS NOT NULL").count()
        current.unpersist()
        current = stepped
    return current.select("id", "dist", "path")


def render_paths(
    paths: DataFrame, labels: DataFrame | None = None, separator: str = ","
) -> DataFrame:
    """``id, dist, path`` with the path as text, ids replaced by labels where given.

    ``labels`` has columns ``id, label``; the join is on path elements, so the
    label table may be as large as the graph.
    """
    if labels is None:
        text = F.array_join(F.transform("path", lambda v: v.cast("string")), separator)
        return paths.select("id", "dist", text.alias("path"))
    steps = paths.select("id", F.posexplode("path").alias("pos", "vertex"))
    named = steps.join(labels.withColumnRenamed("id", "vertex"), "vertex", "left").select(
        "id", F.struct("pos", F.coalesce("label", F.col("vertex").cast("string")).alias("label")).alias("s")
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["label"]), separator)
    # A group is one path, already held as one row's array above.
    cells = named.groupBy("id").agg(text.alias("path"))
    return paths.select("id", "dist").join(cells, "id", "left")
