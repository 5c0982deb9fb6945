"""Graph views over a vertex table ``id, …`` and an edge table ``src, dst, …``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def endpoints(edges: DataFrame) -> DataFrame:
    """Distinct ids that occur on either side of an edge."""
    return (
        edges.select(F.explode(F.array("src", "dst")).alias("id"))
        .filter(F.col("id").isNotNull())
        .distinct()
    )


def graph_build(
    vertices: DataFrame,
    edges: DataFrame,
    defaults: dict[str, Column] | None = None,
    dangling: str = "add",
) -> tuple[DataFrame, DataFrame]:
    """Make vertices and edges consistent.

    ``dangling='add'`` gives endpoints without a vertex row the ``defaults``
    (null for columns not named); ``'drop'`` removes their edges instead.
    """
    if dangling == "add":
        defaults = defaults or {}
        missing = endpoints(edges).join(vertices.select("id"), "id", "left_anti")
        types = dict(vertices.dtypes)
        for name in vertices.columns:
            if name != "id":
                missing = missing.withColumn(name, defaults.get(name, F.lit(None)).cast(types[name]))
        return vertices.unionByName(missing), edges
    if dangling == "drop":
        ids = vertices.select("id")
        kept = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
            ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
        )
        return vertices, kept.select(edges.columns)
    raise ValueError("dangling must be 'add' or 'drop'")


def triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Every edge with the attributes of both ends as ``src_…`` and ``dst_…``."""

    def side(prefix: str) -> DataFrame:
        return vertices.select(
            F.col("id").alias(prefix),
            *[F.col(c).alias(f"{prefix}_{c}") for c in vertices.columns if c != "id"],
        )

    joined = edges.join(side("src"), "src").join(side("dst"), "dst")
    return joined.select(*edges.columns, *[c for c in joined.columns if c not in edges.columns])
