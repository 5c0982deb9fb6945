"""Load jobs: extracted tables → property-graph nodes and edges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import split_cell, to_year
from ..operators.propgraph import (
    edge,
    edge_rows,
    match_both,
    match_source,
    merge_edges,
    merge_nodes,
    node,
    node_id,
    node_rows,
    set_edge_properties,
)


@dataclass
class Load:
    """Rows one input table adds to the graph, before deduplication."""

    nodes: DataFrame
    edges: DataFrame

    def merged(self) -> Load:
        return Load(merge_nodes(self.nodes), merge_edges(self.edges))


def assemble(*loads: Load) -> Load:
    """The graph of several loads: nodes and edges deduplicated once."""
    return Load(merge_nodes(*[x.nodes for x in loads]), merge_edges(*[x.edges for x in loads]))


def _conference(title: Column, year: Column) -> dict[str, Column]:
    return {"title": title, "year": year}


def _id(label: str, identity: dict[str, Column]) -> Column:
    return node_id(label, *identity.values())


def load_conferences(conferences: DataFrame) -> Load:
    """ConferenceTitle –HAS_Edition→ Conference –HELD_IN→ Year."""
    title, year = F.col("booktitle"), to_year("year")
    edition = _conference(title, year)
    return Load(
        node_rows(
            conferences,
            node("ConferenceTitle", {"title": title}),
            node("Conference", edition),
            node("Year", {"year": year}),
        ),
        edge_rows(
            conferences,
            edge("HAS_Edition", node_id("ConferenceTitle", title), _id("Conference", edition)),
            edge("HELD_IN", _id("Conference", edition), node_id("Year", year)),
        ),
    )


def _journal() -> dict[str, Column]:
    return {"title": F.col("journal"), "year": to_year("year"), "volume": F.col("volume")}


def load_journals(journals: DataFrame) -> Load:
    """JournalTitle –HAS_VOLUME→ Journal –ISSUED_IN→ Year."""
    volume, year = _journal(), to_year("year")
    title = F.col("journal")
    return Load(
        node_rows(
            journals,
            node("JournalTitle", {"title": title}),
            node("Journal", volume),
            node("Year", {"year": year}),
        ),
        edge_rows(
            journals,
            edge("HAS_VOLUME", node_id("JournalTitle", title), _id("Journal", volume)),
            edge("ISSUED_IN", _id("Journal", volume), node_id("Year", year)),
        ),
    )


def _load_papers(papers: DataFrame, venue_label: str, venue: dict[str, Column]) -> Load:
    paper = node_id("Paper", F.col("key"))
    abstract = {"abstract": F.col("abstract")} if "abstract" in papers.columns else {}
    words = F.coalesce(split_cell("keywords"), F.array().cast("array<string>"))
    nodes = node_rows(
        papers,
        node("Paper", {"key": F.col("key")}, title=F.col("title"), year=to_year("year"), **abstract),
        node(venue_label, venue),
        per_value=F.transform(words, lambda w: node("Keyword", {"name": w})),
    )
    edges = edge_rows(
        papers,
        edge("HAS", _id(venue_label, venue), paper),
        per_value=F.transform(words, lambda w: edge("MENTIONS", paper, node_id("Keyword", w))),
    )
    return Load(nodes, edges)


def load_conference_papers(papers: DataFrame) -> Load:
    """Conference –HAS→ Paper –MENTIONS→ Keyword."""
    return _load_papers(papers, "Conference", _conference(F.col("booktitle"), to_year("year")))


def load_journal_papers(papers: DataFrame) -> Load:
    """Journal –HAS→ Paper –MENTIONS→ Keyword."""
    return _load_papers(papers, "Journal", _journal())


def load_places(venues: DataFrame) -> Load:
    """Conference –LOCATE_AT→ Place, Conference –HELD_IN→ Year."""
    year = to_year("year")
    place = {"city": F.col("city"), "country": F.col("country")}
    edition = _conference(F.col("booktitle"), year)
    return Load(
        node_rows(
            venues, node("Place", place), node("Conference", edition), node("Year", {"year": year})
        ),
        edge_rows(
            venues,
            edge("LOCATE_AT", _id("Conference", edition), _id("Place", place)),
            edge("HELD_IN", _id("Conference", edition), node_id("Year", year)),
        ),
    )


def load_authorship(authors: DataFrame) -> Load:
    """Author –WRITES{is_lead}→ Paper from ``key, author, is_lead``.

    Papers not loaded yet become key-only nodes.
    """
    key, author = F.col("key"), F.col("author")
    return Load(
        node_rows(authors, node("Paper", {"key": key}), node("Author", {"name": author})),
        edge_rows(
            authors,
            edge("WRITES", node_id("Author", author), node_id("Paper", key), is_lead=F.col("is_lead")),
        ),
    )


def load_authors(lead: DataFrame, coauthors: DataFrame) -> Load:
    """The same from separate ``key, author`` tables of lead and co-authors."""
    return load_authorship(
        lead.select("key", "author", F.lit(True).alias("is_lead")).unionByName(
            coauthors.select("key", "author", F.lit(False).alias("is_lead"))
        )
    )


def _ends(nodes: DataFrame, *labels: str) -> list[DataFrame]:
    return [nodes.filter(F.col("label") == label).select("id") for label in labels]


def _review_rows(reviews: DataFrame, **properties: Column) -> DataFrame:
    rows = reviews.withColumn("reviewer", F.explode(split_cell("reviewer")))
    return edge_rows(
        rows,
        edge("REVIEWS", node_id("Author", F.col("reviewer")), node_id("Paper", F.col("key")), **properties),
    )


def review_edges(reviews: DataFrame, nodes: DataFrame) -> DataFrame:
    """Author –REVIEWS→ Paper where both exist."""
    return match_both(_review_rows(reviews), *_ends(nodes, "Author", "Paper"))


def evolve_reviews(
    edges: DataFrame, reviews: DataFrame, nodes: DataFrame, decision: str = "accept"
) -> DataFrame:
    """Set decision and text on REVIEWS edges, creating those that are missing."""
    rows = _review_rows(
        reviews, decision=F.lit(decision), textual_description=F.col("textual_description")
    )
    old = edges.filter(F.col("type") == "REVIEWS")
    return set_edge_properties(old, match_both(rows, *_ends(nodes, "Author", "Paper")), ["decision", "textual_description"])


def citation_edges(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Cited –CITED_BY→ citing where both papers exist; input columns ``id, cite``."""
    rows = edge_rows(
        pairs, edge("CITED_BY", node_id("Paper", F.col("cite")), node_id("Paper", F.col("id")))
    )
    return match_both(rows, *_ends(nodes, "Paper", "Paper"))


def affiliation_load(affiliations: DataFrame, nodes: DataFrame) -> Load:
    """Author –IS_AFFILIATED_TO→ Organization; only known authors, organizations created."""
    org = F.col("affiliation")
    rows = edge_rows(
        affiliations,
        edge("IS_AFFILIATED_TO", node_id("Author", F.col("author")), node_id("Organization", org)),
    )
    return Load(node_rows(affiliations, node("Organization", {"name": org})), match_source(rows, *_ends(nodes, "Author")))
