"""Extraction jobs: raw record tables → conferences, journals, papers, authors, reviews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import CELL_SEPARATOR
from ..functions.value_types import infer_column_types, typed_headers, typed_values
from ..operators.entities import assign_affiliations, dense_ids, relation_normalize, reviewer_picks
from ..operators.keywords import keywords_topk, venue_last_mention
from ..operators.relational import (
    authorship,
    citation_subset,
    coerce_year,
    lead_coauthor_split,
    project_distinct_notnull,
    trim_all,
    union_all,
)
from ..session import cut_lineage, stored
from ..sources.xml_records import cell_values, citation_pairs, discover_columns, long_cells, read_xml_records, wide_table

REVIEW_TEXT = "Reviewer drawn at random; no remarks."


def extract_conferences(records: DataFrame) -> DataFrame:
    """Distinct ``booktitle, year``; rows with an unreadable year vanish."""
    return coerce_year(records, ["booktitle", "year"], bad_year="drop")


def extract_journals(records: DataFrame) -> DataFrame:
    """Distinct ``journal, volume, year``; an unreadable year stays as null."""
    return coerce_year(records, ["journal", "volume", "year"], bad_year="null")


def _with_keywords(papers: DataFrame, **keyword_options) -> DataFrame:
    """The papers are read for counts, terms and the final join, so they are written once."""
    papers = stored(papers, "distinct-papers")
    cells = keywords_topk(papers.select("key", "title"), "key", "title", **keyword_options)
    return papers.join(cells, "key", "left")


def extract_conference_papers(records: DataFrame, **keyword_options) -> DataFrame:
    """``key, title, booktitle, year, keywords``."""
    columns = ["key", "title", "booktitle", "year"]
    return _with_keywords(coerce_year(records, columns), **keyword_options).select(*columns, "keywords")


def extract_journal_papers(records: DataFrame, **keyword_options) -> DataFrame:
    """``key, title, journal, year, volume, keywords``, all text trimmed."""
    columns = ["key", "title", "journal", "year", "volume"]
    papers = _with_keywords(coerce_year(records, columns), **keyword_options)
    return trim_all(papers.select(*columns, "keywords"))


def extract_venues(records: DataFrame, gazetteer: DataFrame, max_words: int = 2) -> DataFrame:
    """``booktitle, title, year, city, country`` of titles that name both."""
    places = venue_last_mention(records, gazetteer, "key", "title", max_words)
    columns = ["booktitle", "title", "year", "city", "country"]
    return project_distinct_notnull(records.join(places, "key"), columns)


def extract_authors(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lead and co-author tables ``key, author`` of conference or journal records."""
    return lead_coauthor_split(authorship(records))


def generate_reviews(records: DataFrame, k: int = 3, text: str = REVIEW_TEXT, seed: str = "reviewers") -> DataFrame:
    """``key, reviewer, textual_description`` with k drawn reviewers per record."""
    picks = reviewer_picks(authorship(records), k, seed)
    cell = F.array_join(F.transform("picks", lambda p: p["reviewer"]), CELL_SEPARATOR)
    return picks.select("key", cell.alias("reviewer"), F.lit(text).alias("textual_description"))


def authors_affiliation(
    author_tables: list[DataFrame], organizations: DataFrame, seed: str = "affiliation"
) -> DataFrame:
    """``author, affiliation`` for every author of the given tables."""
    authors = union_all([t.select("author") for t in author_tables])
    return assign_affiliations(authors, organizations, seed).withColumnRenamed(
        "organization", "affiliation"
    )


def cited_or_citing_records(records: DataFrame, key: str = "key", cite: str = "cite") -> DataFrame:
    """``record_type, key, cites`` of the records of a dump that cite or are cited; the dump is parsed once."""
    slim = records.select(
        "record_type", F.try_element_at(cell_values(key), F.lit(1)).alias("key"), cell_values(cite).alias("cites"),
        F.filter("cells", lambda c: c["column"].isin(key, cite)).alias("cells"),
    )
    slim = stored(slim, "cited")
    return citation_subset(slim.drop("cells"), citation_pairs(slim, key, cite))


@dataclass
class XmlTables:
    """Typed tables of an XML dump."""

    tables: dict[str, DataFrame]
    column_types: DataFrame
    headers: DataFrame
    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]


def xml_to_tables(
    spark: SparkSession,
    path: str | list[str],
    record_types: list[str],
    relations: list[str] | None = None,
    key: Column | None = None,
    separator: str | None = None,
    entities: dict[str, str] | None = None,
    typed: bool = True,
) -> XmlTables:
    """Wide table with running ids per record type, typed headers, and relation tables.

    Ids run 0, 1, … over all record types in ``(record_type, key)`` order;
    relation nodes continue the sequence.  The dump is parsed once. Columns have the types
    of the headers, columns with several values in a record are sorted arrays; a value that its type can't hold is null.
    With ``typed=False`` all cells are text, several values in one cell.
    """
    key = key if key is not None else F.element_at(F.col("cells"), 1)["value"]
    parsed = read_xml_records(spark, path, record_types, separator, entities)
    records = cut_lineage(
        dense_ids(parsed.withColumn("_key", key), ["record_type", "_key"], "id").drop("_key")
    )
    columns = {r["record_type"]: r["columns"] for r in discover_columns(records).collect()}
    types = cut_lineage(infer_column_types(long_cells(records)))
    kinds = {(r["record_type"], r["column"]): (r["type"], r["is_multi"]) for r in types.collect()}  # a row for each column
    tables = {}
    for record_type, names in columns.items():
        one = records.filter(F.col("record_type") == record_type)
        if typed:
            cells = [typed_values(cell_values(n), *kinds[record_type, n]).alias(n) for n in names]
            tables[record_type] = one.select("id", *cells)
        else:
            tables[record_type] = wide_table(one, record_type, names, ids=["id"])
    nodes, edges = {}, {}
    start = records.count()
    for column in relations or []:
        values = F.filter("cells", lambda c: c["column"] == column)  # noqa: B023
        pairs = records.select("id", F.explode(F.transform(values, lambda c: c["value"])).alias("value"))
        nodes[column], edges[column] = relation_normalize(pairs, "value", "id", start=start)
        start += nodes[column].count()
    return XmlTables(tables, types, typed_headers(types), nodes, edges)
