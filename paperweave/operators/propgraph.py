"""Property graph as two tables, with upsert (MERGE) semantics.

Nodes are ``label, id, <properties>`` and edges ``type, src, dst,
<properties>``; ``id`` is built from the label and the identity properties, so
equal identity means equal row.  Loaders only map rows; duplicates collapse in
one shuffle when the graph is assembled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE_PROPERTIES = ["key", "title", "year", "volume", "abstract", "name", "city", "country"]
EDGE_PROPERTIES = {"is_lead": "boolean", "decision": "string", "textual_description": "string"}


def node_id(label: str, *identity: Column) -> Column:
    """``Label:a|b``; null if any identity part is null."""
    safe = [F.regexp_replace(c.cast("string"), r"([\\|])", r"\\$1") for c in identity]
    parts = [safe[0]]
    for more in safe[1:]:
        parts += [F.lit("|"), more]
    return F.concat(F.lit(f"{label}:"), *parts)


def node(label: str, identity: dict[str, Column], **properties: Column) -> Column:
    """Node row; property values are kept as text."""
    values = {**identity, **properties}
    return F.struct(
        F.lit(label).alias("label"),
        node_id(label, *identity.values()).alias("id"),
        *[values.get(p, F.lit(None)).cast("string").alias(p) for p in NODE_PROPERTIES],
    )


def edge(kind: str, src: Column, dst: Column, **properties: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        src.alias("src"),
        dst.alias("dst"),
        *[properties.get(p, F.lit(None)).cast(t).alias(p) for p, t in EDGE_PROPERTIES.items()],
    )


def _rows(df: DataFrame, items: tuple[Column, ...], per_value: Column | None) -> DataFrame:
    fixed = F.array(*items)
    return df.select(F.explode(fixed if per_value is None else F.concat(fixed, per_value)).alias("r")).select("r.*")


def node_rows(df: DataFrame, *nodes: Column, per_value: Column | None = None) -> DataFrame:
    """All node rows of a table from one scan; rows without identity are left out.

    ``per_value`` is an array of further nodes, one per value of a cell.
    """
    return _rows(df, nodes, per_value).filter("id IS NOT NULL")


def edge_rows(df: DataFrame, *edges: Column, per_value: Column | None = None) -> DataFrame:
    """All edge rows of a table from one scan; edges missing an end are left out."""
    return _rows(df, edges, per_value).filter("src IS NOT NULL AND dst IS NOT NULL")


def merge_nodes(*frames: DataFrame) -> DataFrame:
    """One row per ``label, id``; a key-only row takes the properties of a full one."""
    rows = reduce(DataFrame.unionByName, frames)
    return rows.groupBy("label", "id").agg(*[F.max(p).alias(p) for p in NODE_PROPERTIES])


def merge_edges(*frames: DataFrame) -> DataFrame:
    """One edge per type, ends and properties."""
    return reduce(DataFrame.unionByName, frames).distinct()


def match_both(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges whose two ends exist: ``src`` among ``sources``, ``dst`` among ``targets``."""
    return (
        edges.distinct()
        .join(sources.select(F.col("id").alias("src")), "src", "left_semi")
        .join(targets.select(F.col("id").alias("dst")), "dst", "left_semi")
        .select(edges.columns)
    )


def match_source(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Edges whose source exists; the other end is created by the caller."""
    ids = sources.select(F.col("id").alias("src"))
    return edges.distinct().join(ids, "src", "left_semi").select(edges.columns)


def set_edge_properties(
    old: DataFrame, new: DataFrame, properties: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Upsert by ``keys``: properties of ``new`` win, edges only in one side stay."""
    keys = keys or ["type", "src", "dst"]
    # Both sides are unique per key, so the join cannot multiply rows.
    kept = old.groupBy(*keys).agg(*[F.max(p).alias(f"old_{p}") for p in properties])
    latest = new.groupBy(*keys).agg(*[F.max(p).alias(f"new_{p}") for p in properties])
    return kept.join(latest, keys, "full").select(
        *keys, *[F.coalesce(f"new_{p}", f"old_{p}").alias(p) for p in properties]
    )
