"""Every operator run over the driver's tables, by query key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import views
from .functions.cells import class_iri, join_cell, mint_iri
from .functions.value_types import infer_column_types, infer_value_types, typed_headers
from .operators import relational as rel
from .operators.encoded_triples import EncodedTriples, encoded_author_titles
from .operators.entities import assign_affiliations, assign_reviewers, dense_ids, relation_normalize
from .operators.graph import graph_build, triplets
from .operators.id_dictionary import IdDictionary
from .operators.keywords import keywords_topk, tokens, venue_last_mention
from .operators.ontology import DEFAULT_NAMESPACE, tbox_triples
from .operators.pagerank import pagerank, pagerank_sweep, top_ranked
from .operators.pregel import graph_max_value, propagate_max
from .operators.propgraph import NODE_PROPERTIES
from .operators.shortest_paths import render_paths, shortest_costs, shortest_costs_by_bucket, shortest_paths
from .operators.triples import RDF_TYPE, author_titles, props_of_domains, store_triples
from .plans import bibliography as bib
from .plans import knowledge_graph as kg
from .plans import property_graph as pg
from .session import cut_lineage, discard, release_unused, scratch_path, stored
from .sources import delimited, graph_files
from .sources import xml_records as xml
from .sources.keyed_store import KeyedStore

NS = DEFAULT_NAMESPACE
SOURCE = "C0"
PART_SCHEMA = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"


def _papers(spark: SparkSession, sf: str, kind: str | None = None) -> DataFrame:
    papers = views.bibliography(spark, sf, "papers")
    return papers.filter(F.col("record_type") == kind) if kind else papers


def _conference(spark, sf):
    return _papers(spark, sf, "inproceedings")


def _journal(spark, sf):
    return _papers(spark, sf, "article")


# Sources and sinks


def _written_xml(spark, sf) -> DataFrame:
    path = scratch_path(spark, "xml")
    views.bibliography_xml(spark, sf).write.text(path)
    return xml.read_xml_records(spark, path, ["article", "inproceedings"])


def xml_records(spark, sf):
    def first(name):
        return F.try_element_at(xml.cell_values(name), F.lit(1))

    return _written_xml(spark, sf).select(
        "record_type",
        first("key").alias("key"),
        first("title").alias("title"),
        first("year").alias("year"),
        F.coalesce(first("booktitle"), first("journal")).alias("venue"),
        join_cell(xml.cell_values("author")).alias("authors"),
        join_cell(xml.cell_values("author-orcid")).alias("orcids"),
    )


def schema_discovery(spark, sf):
    found = xml.discover_columns(_written_xml(spark, sf))
    return found.select("record_type", F.array_join("columns", "|").alias("columns"))


def citation_pairs(spark, sf):
    return xml.citation_pairs(_written_xml(spark, sf))


def csv_read_clean(spark, sf):
    part = views.table(spark, sf, "part")
    path = scratch_path(spark, "csv")
    line = F.concat_ws(";", *[F.col(c).cast("string") for c in part.columns])
    # Every 50th row is followed by one with surplus fields, every 40th by an empty one.
    lines = F.array_compact(
        F.array(
            line,
            F.when(F.col("p_partkey") % 50 == 0, F.concat(line, F.lit(";x;y"))),
            F.when(F.col("p_partkey") % 40 == 0, F.lit(";;;;;")),
        )
    )
    part.select(F.explode(lines).alias("value")).write.text(path)
    return delimited.read_delimited(spark, path, PART_SCHEMA, header=False)


def write_csv_roundtrip(spark, sf):
    part = views.table(spark, sf, "part").withColumn(
        "p_name", F.concat(F.lit('say "'), "p_name", F.lit('"; twice'))
    )
    folder = scratch_path(spark, "typed")
    large = F.col("p_size") > 25
    paths = delimited.write_per_type({"large": part.filter(large), "small": part.filter(~large)}, folder)
    read = [delimited.read_delimited(spark, p, PART_SCHEMA) for p in paths.values()]
    return rel.union_all(read)


def csv_quoted_breaks(spark, sf):
    """Texts with line breaks, separators and quotes go through comma-separated files; a file is read by many tasks."""
    path = scratch_path(spark, "breaks")
    texts = views.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.regexp_replace("text", " ", '\n"a", '), F.lit('\n\n"')).alias("body"), "lang"
    )
    delimited.write_delimited(texts, path, sep=",")
    return delimited.read_delimited(spark, path, texts.schema, sep=",", quoted_breaks=True)


def typed_header_read(spark, sf):
    path, header = scratch_path(spark, "data"), scratch_path(spark, "header")
    part = views.table(spark, sf, "part").select(
        "p_partkey", "p_name", F.array("p_brand", "p_type").alias("tags"), "p_retailprice"
    )
    delimited.write_delimited(part, path, header=False)
    names = "p_partkey:integer;p_name:string;tags:string[];p_retailprice:float"
    spark.range(1).select(F.lit(names).alias("value")).coalesce(1).write.text(header)
    rows = delimited.read_with_header_file(spark, path, header)
    return rows.withColumn("tags", F.array_join("tags", ","))


def typed_header(spark, sf):
    return typed_headers(infer_column_types(views.typed_cells(spark, sf)))


def tsv_edges(spark, sf):
    path = scratch_path(spark, "tsv")
    edge = F.concat_ws("\t", "src", "dst")
    lines = F.when(F.col("weight") % 5 == 0, F.array(edge, F.concat(F.lit("no tab "), "src"))).otherwise(F.array(edge))
    views.trade_edges(spark, sf).select(F.explode(lines).alias("value")).write.text(path)
    return graph_files.read_pairs(spark, path)


def ntriples_lines(spark, sf):
    return graph_files.ntriples_lines(kg.abox_triples(views.knowledge_tables(spark, sf), NS))


# Cleaning and joining


def citation_counts(spark, sf):
    pairs = views.bibliography(spark, sf, "citations").filter("cite != '...'")
    return rel.citation_counts(pairs, "id", "cite")


def citation_subset(spark, sf):
    pairs = views.bibliography(spark, sf, "citations").filter("cite != '...'")
    records = _papers(spark, sf).select("record_type", "key")
    return rel.citation_subset(records, pairs.withColumnRenamed("id", "key")).select("record_type", "key")


def citation_subset_xml(spark, sf):
    """From the dump itself: citation pairs, the keys on either side, and their records."""
    return bib.cited_or_citing_records(_written_xml(spark, sf)).select("record_type", "key")


def project_distinct_notnull(spark, sf):
    lines = views.table(spark, sf, "lineitem").select(
        F.expr("nullif(l_partkey, l_suppkey * 20)").alias("l_partkey"),
        F.expr("nullif(l_suppkey, 7)").alias("l_suppkey"),
    )
    return rel.project_distinct_notnull(lines, ["l_partkey", "l_suppkey"])


def lead_coauthor_split(spark, sf):
    lead, co = rel.lead_coauthor_split(rel.authorship(_papers(spark, sf)))
    return lead.withColumn("is_lead", F.lit(True)).unionByName(co.withColumn("is_lead", F.lit(False)))


def trim_all(spark, sf):
    return rel.trim_all(_papers(spark, sf).select("key", F.concat(F.lit("\t "), "title", F.lit(" \n")).alias("title"), "year"))


def coerce_year(spark, sf):
    """Years as written, with a suffix, with blanks, and unreadable in two ways."""
    odd = F.expr(
        "CASE num % 6 WHEN 0 THEN year || 'd' WHEN 1 THEN ' ' || year || ' ' WHEN 2 THEN year || 'f' "
        "WHEN 3 THEN year || '.0' ELSE year END"
    )
    columns, papers = ["booktitle", "year"], _papers(spark, sf).withColumn("year", odd)
    drop = rel.coerce_year(papers, columns, bad_year="drop")
    null = rel.coerce_year(papers, columns, bad_year="null")
    return drop.withColumn("bad_year", F.lit("drop")).unionByName(null.withColumn("bad_year", F.lit("null")))


def explode_multivalue(spark, sf):
    return rel.explode_multivalue(_papers(spark, sf).select("key", "author"), "author")


def implode_multivalue(spark, sf):
    words = views.table(spark, sf, "documents").select("doc_id", tokens("text").alias("words"))
    return words.select("doc_id", join_cell("words").alias("cell"))


def _single_values(spark, sf):
    return views.typed_cells(spark, sf).select("record_type", "column", F.explode("values").alias("value"))


def infer_value_type(spark, sf):
    cells = _single_values(spark, sf).select(F.concat_ws(".", "record_type", "column").alias("column"), "value")
    return infer_value_types(cells)


def infer_column_type(spark, sf):
    return infer_column_types(views.typed_cells(spark, sf))


def mint_iris(spark, sf):
    return _papers(spark, sf).select("key", mint_iri("key", NS).alias("iri"), mint_iri("booktitle", NS).alias("venue_iri"))


def type_to_class(spark, sf):
    conferences = views.bibliography(spark, sf, "kg_conferences")
    papers = views.bibliography(spark, sf, "kg_papers")
    c = class_iri("type", NS, kg.CONFERENCE_TYPES, kg.RENAMED_TYPES)
    p = class_iri("type", NS, ["FullPaper", "Poster"])
    rows = conferences.select(mint_iri("conf_id", NS).alias("s"), c.alias("o")).unionByName(
        papers.select(mint_iri("id", NS).alias("s"), p.alias("o"))
    )
    return rows.dropna("any")


def right_outer_join(spark, sf):
    editions = views.bibliography(spark, sf, "kg_has_proceedings")
    published = views.bibliography(spark, sf, "kg_has_publication")
    return rel.right_outer_join(published, editions, "edition_id").select("edition_id", "publication_id", "conf_id")


def venue_of_publication(spark, sf):
    t = {n: views.bibliography(spark, sf, f"kg_{n}") for n in ("has_publication", "has_proceedings", "contains_volume")}
    return rel.venue_of_publication(t["has_publication"], t["has_proceedings"], t["contains_volume"])


def union_all_authors(spark, sf):
    sides = [*bib.extract_authors(_conference(spark, sf)), *bib.extract_authors(_journal(spark, sf))]
    return rel.union_all([s.select("author") for s in sides]).groupBy("author").agg(F.count("*").alias("n"))


# Texts


def keywords(spark, sf):
    return keywords_topk(views.table(spark, sf, "documents"), "doc_id", "text")


def venue_mentions(spark, sf):
    words = views.table(spark, sf, "benchmark").select(F.explode(tokens("text")).alias("name")).distinct()
    kind = F.when(F.length("name") % 2 == 0, "city").otherwise("country")
    return venue_last_mention(
        views.table(spark, sf, "documents"), words.select(kind.alias("kind"), "name"), "doc_id", "text"
    )


# Extraction and assignment


def extract_conferences(spark, sf):
    return bib.extract_conferences(_conference(spark, sf))


def extract_journals(spark, sf):
    return bib.extract_journals(_journal(spark, sf))


def extract_conference_papers(spark, sf):
    return bib.extract_conference_papers(_conference(spark, sf))


def extract_journal_papers(spark, sf):
    return bib.extract_journal_papers(_journal(spark, sf))


def extract_venues(spark, sf):
    return bib.extract_venues(_conference(spark, sf), views.bibliography(spark, sf, "gazetteer"))


def _tagged(lead, co):
    return lead.withColumn("part", F.lit("lead")).unionByName(co.withColumn("part", F.lit("co")))


def extract_conference_authors(spark, sf):
    return _tagged(*bib.extract_authors(_conference(spark, sf)))


def extract_journal_authors(spark, sf):
    return _tagged(*bib.extract_authors(_journal(spark, sf)))


def assign_reviewer_rows(spark, sf):
    return assign_reviewers(rel.authorship(_papers(spark, sf))).select("key", "reviewer", "pick")


def reviewer_tables(spark, sf):
    return bib.generate_reviews(_papers(spark, sf))


def authors_affiliation(spark, sf):
    tables = [*bib.extract_authors(_conference(spark, sf)), *bib.extract_authors(_journal(spark, sf))]
    return bib.authors_affiliation(tables, views.bibliography(spark, sf, "organizations"))


def affiliations(spark, sf):
    authors = rel.authorship(_papers(spark, sf))
    return assign_affiliations(authors, views.bibliography(spark, sf, "organizations"))


# Property graph


def _half(papers: DataFrame, kind: str) -> DataFrame:
    return papers.filter(F.col("record_type") == kind)


def _load(name: str, papers: DataFrame, spark, sf) -> pg.Load:
    conference, journal = _half(papers, "inproceedings"), _half(papers, "article")
    if name == "conferences":
        return pg.load_conferences(bib.extract_conferences(conference))
    if name == "journals":
        return pg.load_journals(bib.extract_journals(journal))
    if name == "conference_papers":
        return pg.load_conference_papers(bib.extract_conference_papers(conference))
    if name == "journal_papers":
        return pg.load_journal_papers(bib.extract_journal_papers(journal))
    if name == "places":
        gazetteer = views.bibliography(spark, sf, "gazetteer")
        return pg.load_places(bib.extract_venues(conference, gazetteer))
    return pg.load_authorship(rel.authorship(conference if name == "conference_authors" else journal))


LOADS = (
    "conferences", "journals", "conference_papers", "journal_papers", "places",
    "conference_authors", "journal_authors",
)


def _loads(spark, sf, *names: str) -> list[pg.Load]:
    papers = views.stored_papers(spark, sf)
    return [_load(n, papers, spark, sf) for n in names]


def _entity_nodes(spark, sf, papers: DataFrame | None = None) -> DataFrame:
    """Paper and Author nodes, the ends that reviews and citations must match."""
    papers = views.stored_papers(spark, sf) if papers is None else papers
    loads = [_load(n, papers, spark, sf) for n in ("conference_authors", "journal_authors")]
    return cut_lineage(rel.union_all([x.nodes for x in loads]).select("label", "id").distinct())


def _load_summary(load: pg.Load) -> DataFrame:
    """Nodes and edges of one load in one table."""
    merged = load.merged()
    nodes = merged.nodes.select(F.lit("node").alias("part"), F.col("label").alias("kind"), F.col("id").alias("a"), F.lit("").alias("b"))
    edges = merged.edges.select(F.lit("edge").alias("part"), F.col("type").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"))
    return nodes.unionByName(edges)


def load_conferences(spark, sf):
    return _load_summary(*_loads(spark, sf, "conferences"))


def load_journals(spark, sf):
    return _load_summary(*_loads(spark, sf, "journals"))


def load_conference_papers(spark, sf):
    return _load_summary(*_loads(spark, sf, "conference_papers"))


def load_journal_papers(spark, sf):
    return _load_summary(*_loads(spark, sf, "journal_papers"))


def load_places(spark, sf):
    return _load_summary(*_loads(spark, sf, "places"))


def _graph(spark, sf, papers: DataFrame | None = None) -> pg.Load:
    papers = views.stored_papers(spark, sf) if papers is None else papers
    loads = [_load(n, papers, spark, sf) for n in LOADS]
    authors = cut_lineage(rel.authorship(papers).select("author").distinct())
    known = authors.select(F.lit("Author").alias("label"), pg.node_id("Author", F.col("author")).alias("id"))
    drawn = assign_affiliations(authors, views.bibliography(spark, sf, "organizations"))
    affiliated = drawn.withColumnRenamed("organization", "affiliation")
    return pg.assemble(*loads, pg.affiliation_load(affiliated, known))


def nodes_all(spark, sf):
    return _graph(spark, sf).nodes.select("label", "id", *NODE_PROPERTIES)


def nodes_paper(spark, sf):
    loads = _loads(spark, sf, "conference_papers", "journal_papers", "conference_authors", "journal_authors")
    rows = [x.nodes.filter(F.col("label") == "Paper") for x in loads]
    return pg.merge_nodes(*rows).select("id", "key", "title", "year")


def edges_all(spark, sf):
    """All eleven edge types; reviews and citations only between nodes of the graph.

    Each kind of edges is written before the next is made, so that the disk holds the shuffles of one.
    """
    papers = views.stored_papers(spark, sf)
    ends = _entity_nodes(spark, sf, papers)

    def written(edges: DataFrame, name: str) -> DataFrame:
        table = stored(edges, name)
        release_unused(spark)
        return table

    cited = written(pg.citation_edges(views.bibliography(spark, sf, "citations").filter("cite != '...'"), ends), "cited")
    reviews = written(pg.review_edges(bib.generate_reviews(papers), ends), "reviews")
    del ends
    graph = written(_graph(spark, sf, papers).edges, "graph-edges")
    discard(papers)
    release_unused(spark)
    return pg.merge_edges(graph, reviews, cited).select("type", "src", "dst", "is_lead")


def edges_writes(spark, sf):
    loads = _loads(spark, sf, "conference_authors", "journal_authors")
    return pg.merge_edges(*[x.edges for x in loads]).select("src", "dst", "is_lead")


def _review_table(spark, sf, kind):
    """Two reviewer names per paper, some unknown to the graph."""
    papers = _papers(spark, sf, kind)
    cell = F.concat(
        F.lit("Customer "), F.lpad(F.expr("CAST(num % 50 AS STRING)"), 9, "0"),
        F.lit("|Stranger "), F.expr("CAST(num % 5 AS STRING)"),
        F.lit("|Clerk "), F.lpad(F.expr("CAST((num + 1) % 97 AS STRING)"), 9, "0"),
    )
    return papers.select("key", cell.alias("reviewer"), F.lit(bib.REVIEW_TEXT).alias("textual_description"))


def review_edges(spark, sf):
    reviews = _review_table(spark, sf, "inproceedings").unionByName(_review_table(spark, sf, "article"))
    return pg.review_edges(reviews, _entity_nodes(spark, sf)).select("src", "dst")


def review_evolve(spark, sf):
    nodes = _entity_nodes(spark, sf)
    old = pg.review_edges(_review_table(spark, sf, None), nodes)
    new = _review_table(spark, sf, "inproceedings")
    return pg.evolve_reviews(old, new, nodes).select("src", "dst", "decision", "textual_description")


def citation_edges(spark, sf):
    pairs = views.bibliography(spark, sf, "citations").filter("cite != '...'")
    return pg.citation_edges(pairs, _entity_nodes(spark, sf)).select("src", "dst")


def citation_file_edges(spark, sf):
    """Citations from a comma-separated file without a header."""
    path = scratch_path(spark, "cited")
    views.bibliography(spark, sf, "citations").select("id", "cite").write.option("header", False).csv(path)
    pairs = delimited.read_delimited(spark, path, "id STRING, cite STRING", sep=",", header=False)
    return pg.citation_edges(pairs.filter("cite != '...'"), _entity_nodes(spark, sf)).select("src", "dst")


# Ids


def dense_id_rows(spark, sf):
    return dense_ids(_papers(spark, sf).select("key"), ["key"])


def relation_tables(spark, sf):
    authors = rel.explode_multivalue(_papers(spark, sf).select("num", "author"), "author")
    nodes, edges = relation_normalize(authors, "author", "num")
    return nodes.select(F.lit("node").alias("part"), F.col("node_id").alias("a"), F.col("value").alias("b")).unionByName(
        edges.select(F.lit("edge").alias("part"), F.col("start_id").alias("a"), F.col("end_id").cast("string").alias("b"))
    )


def xml_to_tables(spark, sf):
    path = scratch_path(spark, "xml")
    views.bibliography_xml(spark, sf).write.text(path)
    made = bib.xml_to_tables(spark, path, ["article", "inproceedings"], typed=False)
    columns = ["id", "key", "author", "title", "year", "cite"]
    return rel.union_all([t.select(*columns, F.lit(n).alias("record_type")) for n, t in made.tables.items()])


def xml_typed_tables(spark, sf):
    """Typed cells, headers, and the nodes and edges of two relations, each as ``part, kind, id, name, value``."""
    path = scratch_path(spark, "xml")
    views.bibliography_xml(spark, sf).write.text(path)
    key = F.try_element_at(xml.cell_values("key"), F.lit(1))
    made = bib.xml_to_tables(spark, path, ["article", "inproceedings"], relations=["author", "year"], key=key)
    parts = []

    def add(df, part, kind, identity, name, value):
        parts.append(df.select(F.lit(part).alias("part"), F.lit(kind).alias("kind"), identity.cast("long").alias("id"), name.alias("name"), value.cast("string").alias("value")))

    for kind, table in made.tables.items():
        fields = {f.name: f.dataType for f in table.schema.fields}
        if not isinstance(fields["author"], T.ArrayType) or not isinstance(fields["mdate"], T.DateType):
            raise ValueError(f"types of {kind}: {fields}")
        older = F.date_add("mdate", -1)  # works on the type, not on the text
        cells = {"key": F.col("key"), "year": F.col("year"), "mdate": older, "author": F.array_join("author", "|")}
        for name, value in cells.items():
            add(table.filter(value.isNotNull()), "cell", kind, F.col("id"), F.lit(name), value)
    headers = made.headers
    parts.append(headers.select(F.lit("header").alias("part"), F.col("record_type").alias("kind"), F.lit(None).cast("long").alias("id"), F.lit("").alias("name"), F.col("header").alias("value")))
    for relation in made.nodes:
        add(made.nodes[relation], "node", relation, F.col("node_id"), F.lit(""), F.col("value"))
        add(made.edges[relation], "edge", relation, F.col("start_id"), F.lit(""), F.col("end_id"))
    return rel.union_all(parts)


def id_dictionary_second_load(spark, sf):
    """Ids of authors after a load of some papers and one of all."""
    papers = _papers(spark, sf)
    ids = IdDictionary(spark, scratch_path(spark, "ids"), start=100, buckets=8)
    ids.extend(rel.explode_multivalue(papers.filter("num % 3 = 0").select("author"), "author"), "author")
    ids.extend(rel.explode_multivalue(papers.filter("num % 3 = 0 OR num % 7 < 4").select("author"), "author"), "author")
    authors = rel.explode_multivalue(papers.select("num", "author"), "author")
    ids.extend(authors, "author")
    edges = ids.edges(authors, "num", "author")
    nodes = ids.read().select(F.lit("node").alias("part"), F.col("node_id").alias("a"), F.col("value").alias("b"))
    return nodes.union(edges.select(F.lit("edge"), "start_id", F.col("end_id").cast("string")))


def graph_merge_incremental(spark, sf):
    """A graph that two overlapping loads were merged into, nodes and edges; the second brings the papers' titles."""
    papers = views.stored_papers(spark, sf)
    nodes = KeyedStore(spark, scratch_path(spark, "nodes"), ["label", "id"], pg.merge_nodes, buckets=8)
    edges = KeyedStore(spark, scratch_path(spark, "edges"), ["type", "src", "dst"], pg.merge_edges, buckets=8)
    for part in ("num % 3 = 0", "num % 3 > 0 OR num % 5 = 0"):
        half = papers.filter(part)
        loads = [_load(n, half, spark, sf) for n in ("conferences", "journals", "conference_authors", "journal_authors")]
        titled = [pg.node_rows(papers, pg.node("Paper", {"key": F.col("key")}, title=F.col("title")))] if "OR" in part else []
        nodes.load(rel.union_all([x.nodes for x in loads] + titled))
        edges.load(rel.union_all([x.edges for x in loads]))
    shown = F.when(F.col("label") == "Paper", F.col("title")).otherwise(F.lit(""))
    found = nodes.read().select(F.lit("node").alias("part"), F.col("label").alias("kind"), F.col("id").alias("a"), shown.alias("b"))
    return found.union(edges.read().select(F.lit("edge"), "type", "src", "dst"))


# Graph analytics


def _built(spark, sf):
    """Trade graph with vertex rows for every end; suppliers are left to the default."""
    vertices = views.trade_vertices(spark, sf).filter("id NOT LIKE 'S%'")
    return graph_build(vertices, views.trade_edges(spark, sf), {"value": F.lit(1)})


def graph_build_vertices(spark, sf):
    return _built(spark, sf)[0].select("id", "value")


def triplet_rows(spark, sf):
    return triplets(*_built(spark, sf)).select("src", "dst", "weight", "src_value", "dst_value")


def graph_max(spark, sf):
    return graph_max_value(views.trade_vertices(spark, sf))


def graph_max_reach(spark, sf):
    return propagate_max(views.trade_vertices(spark, sf), views.trade_edges(spark, sf, closed=False))


def _costs(spark, sf, search, weight=None):
    """Costs need no order among ids, so they are found on numbered ones; text is made of the result only."""
    weight = F.col("weight") if weight is None else weight
    if not views.trade_keys_fit(spark, sf):
        return search(views.trade_edges(spark, sf).withColumn("weight", weight), SOURCE)
    found = search(views.trade_edges_numbered(spark, sf).withColumn("weight", weight), views.trade_number("C", 0))
    return found.select(views.trade_name("id").alias("id"), "dist")


def sssp_cost(spark, sf):
    return _costs(spark, sf, shortest_costs)


def sssp_buckets(spark, sf):
    return _costs(spark, sf, shortest_costs_by_bucket)


def sssp_cost_fractional(spark, sf):
    return _costs(spark, sf, shortest_costs, F.col("weight") / F.lit(8.0))


def sssp_path(spark, sf):
    return render_paths(shortest_paths(views.trade_edges(spark, sf), SOURCE))


def _rounded(ranks):
    return ranks.withColumn("pagerank", F.round("pagerank", 6))


def _ranked(spark, sf, rank):
    """Ranks are found on numbered vertices; text is made of the result only."""
    if not views.trade_keys_fit(spark, sf):
        return _rounded(rank(views.trade_edges(spark, sf)))
    found = rank(views.trade_edges_numbered(spark, sf).select("src", "dst"))
    return _rounded(found.withColumn("id", views.trade_name("id")))


def pagerank_all(spark, sf):
    return _ranked(spark, sf, lambda edges: pagerank(edges, parallel=False))


def pagerank_top(spark, sf):
    return top_ranked(pagerank_all(spark, sf))


def pagerank_grid(spark, sf):
    swept = _ranked(spark, sf, lambda edges: pagerank_sweep(edges, [0.7, 0.15], [2, 4, 20], parallel=False))
    return swept.select("id", "reset_prob", "max_iter", "pagerank")


# Knowledge graph


def _triples(spark, sf):
    triples = kg.knowledge_graph(spark, views.knowledge_tables(spark, sf), NS)
    return store_triples(triples, scratch_path(spark, "triples"))


def tbox_usage(spark, sf):
    """The ontology, and how often the data uses each of its terms."""
    data = kg.abox_triples(views.knowledge_tables(spark, sf), NS)
    term = F.when(F.col("p") == RDF_TYPE, F.col("o")).otherwise(F.col("p"))
    used = data.groupBy(term.alias("s")).agg(F.count("*").alias("n"))
    return tbox_triples(spark, NS).join(used, "s", "left").select(
        "s", "p", "o", "o_is_literal", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def _domain_usage(spark, sf, classes):
    triples = _triples(spark, sf)
    found = props_of_domains(triples, [NS + c for c in classes])
    used = triples.groupBy("p").agg(F.count("*").alias("n"))
    return found.join(used, "p", "left").select("p", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def props_of_domain(spark, sf):
    return _domain_usage(spark, sf, ["Author"])


def props_of_two_domains(spark, sf):
    return _domain_usage(spark, sf, ["Conference", "Journal"])


def abox(spark, sf):
    return kg.abox_triples(views.knowledge_tables(spark, sf), NS)


def abox_from_csv(spark, sf):
    """The tables go through comma-separated files, quoted line breaks included."""
    tables = {}
    for name, rows in views.knowledge_tables(spark, sf).items():
        path = scratch_path(spark, name)
        delimited.write_delimited(rows, path, sep=",")
        tables[name] = delimited.read_delimited(spark, path, rows.schema, sep=",", quoted_breaks=True)
    return kg.abox_triples(tables, NS)


def ntriples_roundtrip(spark, sf):
    """Ontology and data as N-Triples files, read back line by line; some subjects hold signs that IRIs may not."""
    path = scratch_path(spark, "nt")
    odd = F.concat(F.lit(NS + "odd/"), "n_name", F.lit(' a>b\n<"\\é👍'))
    nations = views.table(spark, sf, "nation").select(odd.alias("s"), F.lit(RDF_TYPE).alias("p"), F.lit(NS + "{x}").alias("o"), F.lit(False).alias("o_is_literal"))
    triples = kg.knowledge_graph(spark, views.knowledge_tables(spark, sf), NS).select("s", "p", "o", "o_is_literal")
    graph_files.write_ntriples(triples.unionByName(nations), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def author_title_cells(spark, sf):
    return author_titles(_triples(spark, sf), NS).select("author", "part", "titles")


def author_title_cells_by_keyword(spark, sf):
    return author_titles(_triples(spark, sf), NS, keyword="Brand#3").select("author", "part", "titles")


def _encoded_titles(spark, sf, keyword=None):
    """The tables that lead to the encoded ones are deleted when the next is written."""
    papers = views.stored_papers(spark, sf)
    merged = stored(kg.knowledge_graph(spark, views.knowledge_tables(spark, sf, papers), NS), "merged-triples")
    discard(papers)
    release_unused(spark)
    triples = store_triples(merged, scratch_path(spark, "triples"))
    discard(merged)
    del merged, papers
    release_unused(spark)
    store = EncodedTriples(triples)
    discard(triples)
    return encoded_author_titles(store, NS, keyword=keyword).select("author", "part", "titles")


def author_title_cells_encoded(spark, sf):
    return _encoded_titles(spark, sf)


def author_title_cells_encoded_by_keyword(spark, sf):
    return _encoded_titles(spark, sf, keyword="Brand#3")


QUERIES = {
    "xml_records": xml_records,
    "schema_discovery": schema_discovery,
    "csv_read_clean": csv_read_clean,
    "write_csv_roundtrip": write_csv_roundtrip,
    "csv_quoted_breaks": csv_quoted_breaks,
    "typed_header_read": typed_header_read,
    "typed_header": typed_header,
    "tsv_edges": tsv_edges,
    "ntriples_lines": ntriples_lines,
    "citation_pairs": citation_pairs,
    "citation_counts": citation_counts,
    "citation_subset": citation_subset,
    "citation_subset_xml": citation_subset_xml,
    "citation_file_edges": citation_file_edges,
    "reviewer_tables": reviewer_tables,
    "authors_affiliation": authors_affiliation,
    "abox_from_csv": abox_from_csv,
    "ntriples_roundtrip": ntriples_roundtrip,
    "project_distinct_notnull": project_distinct_notnull,
    "lead_coauthor_split": lead_coauthor_split,
    "trim_all": trim_all,
    "coerce_year": coerce_year,
    "explode_multivalue": explode_multivalue,
    "implode_multivalue": implode_multivalue,
    "infer_value_type": infer_value_type,
    "infer_column_type": infer_column_type,
    "mint_iri": mint_iris,
    "type_to_class": type_to_class,
    "keywords_topk": keywords,
    "venue_last_mention": venue_mentions,
    "right_outer_join": right_outer_join,
    "venue_of_publication": venue_of_publication,
    "affiliation_edges": affiliations,
    "assign_reviewers": assign_reviewer_rows,
    "union_all_authors": union_all_authors,
    "nodes_paper": nodes_paper,
    "nodes_all": nodes_all,
    "edges_all": edges_all,
    "edges_writes": edges_writes,
    "review_edges": review_edges,
    "review_evolve": review_evolve,
    "citation_edges": citation_edges,
    "extract_conferences": extract_conferences,
    "extract_journals": extract_journals,
    "extract_conference_papers": extract_conference_papers,
    "extract_journal_papers": extract_journal_papers,
    "extract_venues": extract_venues,
    "extract_conference_authors": extract_conference_authors,
    "extract_journal_authors": extract_journal_authors,
    "load_conferences": load_conferences,
    "load_journals": load_journals,
    "load_conference_papers": load_conference_papers,
    "load_journal_papers": load_journal_papers,
    "load_places": load_places,
    "relation_normalize": relation_tables,
    "dense_ids": dense_id_rows,
    "xml_to_tables": xml_to_tables,
    "xml_typed_tables": xml_typed_tables,
    "id_dictionary_second_load": id_dictionary_second_load,
    "graph_merge_incremental": graph_merge_incremental,
    "graph_build": graph_build_vertices,
    "triplets": triplet_rows,
    "graph_max_value": graph_max,
    "graph_max_reach": graph_max_reach,
    "sssp_cost": sssp_cost,
    "sssp_buckets": sssp_buckets,
    "sssp_cost_fractional": sssp_cost_fractional,
    "sssp_path": sssp_path,
    "pagerank_top": pagerank_top,
    "pagerank_all": pagerank_all,
    "pagerank_sweep": pagerank_grid,
    "tbox_triples": tbox_usage,
    "props_of_domain": props_of_domain,
    "props_of_domains": props_of_two_domains,
    "abox_triples": abox,
    "author_titles": author_title_cells,
    "author_titles_by_keyword": author_title_cells_by_keyword,
    "author_titles_encoded": author_title_cells_encoded,
    "author_titles_encoded_by_keyword": author_title_cells_encoded_by_keyword,
}
