"""Connected components over an edge table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of ``edges(a, b)``; component is the smallest id reachable.

    Each round takes the smallest label among neighbours (merged map-side, so a vertex
    with very many links costs one row per task) and then jumps to the label's own
    label. Labels are written each round, so the join's sides are plain
    shuffles that AQE may split. No edges give an empty table.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    while True:
        theirs = labels.select(F.col("id").alias("a"), F.col("component").alias("near"))
        best = both.join(theirs, "a").groupBy(F.col("b").alias("id")).agg(F.min("near").alias("near"))
        hooked = labels.join(best, "id", "left").select(
            "id", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        hooked = stored(hooked, "hooked")
        upper = hooked.select(F.col("id").alias("component"), F.col("component").alias("top"))
        jumped = hooked.join(upper, "component", "left").select(
            "id", "before", F.least("component", "top").alias("component")
        )
        jumped = stored(jumped, "jumped")
        labels = jumped.select("id", "component")
        if not jumped.filter("before <> component").limit(1).count():
            return labels
