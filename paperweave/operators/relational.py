"""Cleaning, splitting and joining of record tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import is_lead_author, split_cell, strip, to_year
from ..session import cut_lineage, shuffle_partitions


def project_distinct_notnull(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of the named columns, rows with any null left out."""
    return df.select(*columns).dropna("any").distinct()


def trim_all(df: DataFrame) -> DataFrame:
    """Strip whitespace at both ends of every string column."""
    return df.select(
        *[
            strip(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def coerce_year(
    df: DataFrame, columns: list[str], year: str = "year", bad_year: str = "null"
) -> DataFrame:
    """Distinct complete rows with ``year`` as a number.

    ``bad_year='drop'`` reads the year first, so rows with an unreadable one
    vanish; ``'null'`` takes the distinct complete rows as they are written and
    then reads the year, so differently written years stay apart as rows.
    """
    if bad_year == "drop":
        return project_distinct_notnull(df.withColumn(year, to_year(year)), columns)
    if bad_year == "null":
        complete = df.select(*columns).dropna("any")
        return complete.distinct().withColumn(year, to_year(year))
    raise ValueError("bad_year must be 'drop' or 'null'")


def explode_multivalue(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """One row per value of a ``|`` cell or array; empty cells give no row."""
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    values = F.col(column) if is_array else split_cell(column)
    rest = [c for c in df.columns if c != column]
    out = out or column
    return df.select(*rest, F.explode(values).alias(out)).filter(F.col(out).isNotNull())


def authorship(records: DataFrame, key: str = "key", author: str = "author") -> DataFrame:
    """Distinct ``key, author, is_lead`` from records with multi-valued author cells."""
    complete = records.select(key, author).dropna("any")
    rows = explode_multivalue(complete, author).distinct()
    return rows.select(key, author, is_lead_author(author, key).alias("is_lead"))


def lead_coauthor_split(authors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lead rows and co-author rows as two ``key, author`` tables."""
    pairs = [c for c in authors.columns if c != "is_lead"]
    return authors.filter("is_lead").select(*pairs), authors.filter("NOT is_lead").select(*pairs)


def union_all(frames: list[DataFrame], align: bool = False) -> DataFrame:
    """Union by name without deduplication; ``align`` fills missing columns with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=align), frames)


def cited_or_citing(pairs: DataFrame, key: str = "key", cite: str = "cite") -> DataFrame:
    """Distinct keys on either side of a citation."""
    return pairs.select(F.explode(F.array(key, cite)).alias("key")).distinct()


def citation_subset(
    records: DataFrame, pairs: DataFrame, key: str = "key", cite: str = "cite"
) -> DataFrame:
    """Records that cite or are cited, for all record types in one semi-join."""
    keys = cited_or_citing(pairs, key, cite)
    return records.join(keys.withColumnRenamed("key", key), key, "left_semi")


def citation_counts(pairs: DataFrame, key: str = "key", cite: str = "cite") -> DataFrame:
    """One row: distinct citing keys, cited keys, and keys on either side.

    Each key is reduced to one row with two flags first, so the counts need a
    single shuffle of distinct keys.
    """
    sides = F.array(
        F.struct(F.col(key).alias("k"), F.lit(True).alias("citing")),
        F.struct(F.col(cite).alias("k"), F.lit(False).alias("citing")),
    )
    flags = (
        pairs.select(F.explode(sides).alias("s"))
        .groupBy("s.k")
        .agg(F.bool_or("s.citing").alias("citing"), F.bool_or(~F.col("s.citing")).alias("cited"))
    )
    return flags.agg(
        F.count_if("citing").alias("n_citing"),
        F.count_if("cited").alias("n_cited"),
        F.count("*").alias("n_either"),
    )


def right_outer_join(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Every right row, with left columns null where nothing matches.

    Matches and rows without one are joined apart: in an inner join a key with
    very many left rows can be split, or met by a broadcast of the right side.
    """
    keys = [on] if isinstance(on, str) else on
    matched = left.join(right, keys)
    alone = right.join(left.select(*keys), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def venue_of_publication(
    publications: DataFrame, proceedings: DataFrame, volumes: DataFrame
) -> DataFrame:
    """``publication_id, edition_id, venue_id`` over conferences and journals.

    Editions keep their rows in the outer joins; those without a publication
    are dropped afterwards, which lets the optimizer use inner joins.
    """
    conference = right_outer_join(publications, proceedings, "edition_id")
    journal = right_outer_join(publications, volumes, "edition_id")
    both = union_all(
        [
            conference.withColumnRenamed("conf_id", "venue_id"),
            journal.withColumnRenamed("journal_id", "venue_id"),
        ]
    )
    return both.dropna(subset=["publication_id"]).select("publication_id", "edition_id", "venue_id")


def concat_values(
    df: DataFrame,
    group: str,
    value: str,
    separator: str = ", ",
    values_per_part: int = 1_000_000,
) -> DataFrame:
    """``group, part, values``: the distinct values of each group as sorted text.

    Values are numbered within their group in sorted order; part i holds the
    numbers from ``i * values_per_part`` on, so parts follow each other and joining
    them in order gives the whole text.  Sorting is by ranges of (group, value):
    a group of any size spreads over as many tasks as it needs, and a
    number is a position within a range plus the sizes of the group's ranges before.
    """
    parts = shuffle_partitions(df.sparkSession)
    distinct = df.select(group, value).dropna("any").distinct()
    ranged = cut_lineage(distinct.repartitionByRange(parts, group, value).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A group has at most one row of sizes for each range.
    offsets = cut_lineage(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(value)) - 1
    numbered = ranged.withColumn("_at", inside).join(offsets, [group, "_range"])
    part = F.floor((F.col("_before") + F.col("_at")) / F.lit(values_per_part)).cast("int")
    text = F.array_join(F.array_sort(F.collect_list(value)), separator)
    return numbered.groupBy(group, part.alias("part")).agg(text.alias("values"))
