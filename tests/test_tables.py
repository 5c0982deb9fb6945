import collections
import string
from pathlib import Path

from pyspark.sql import functions as F

from paperweave import driver_queries
from paperweave.functions import cells
from paperweave.functions.cells import mint_iri, to_year
from paperweave.operators import entities
from paperweave.operators import relational as rel
from paperweave.operators.entities import assign_affiliations, assign_reviewers, dense_ids, relation_normalize, reviewer_cells
from paperweave.operators.keywords import keywords_topk, venue_last_mention
from paperweave.operators.ontology import tbox_triples
from paperweave.operators.propgraph import set_edge_properties
from paperweave.operators.skew import hot_keys, lookup
from paperweave.operators.triples import RDF_TYPE, author_titles, props_of_domains
from paperweave.plans import bibliography as bib
from paperweave.plans import knowledge_graph as kg
from paperweave.plans import property_graph as pg
from paperweave.plans.knowledge_graph import abox_triples, knowledge_graph
from paperweave.session import cut_lineage, shared_folder

NS = "http://example.org/biblio/"


def test_trim_and_year(spark, rows):
    df = spark.createDataFrame([("\t a b \n", " 1999 "), ("x", "19x"), (None, "2001.0")], "t string, y string")
    assert [r[0] for r in rel.trim_all(df).collect()] == ["a b", "x", None]
    assert [r[0] for r in df.select(cells.to_year("y")).collect()] == [1999, None, 2001]
    kept = rel.coerce_year(df, ["t", "y"], year="y", bad_year="drop").collect()
    assert [tuple(r) for r in kept] == [("\t a b \n", 1999)]
    assert rel.coerce_year(df, ["t", "y"], year="y", bad_year="null").count() == 2


def test_authorship_split(spark, rows):
    df = spark.createDataFrame([("j/Bell99", "Ann Bell|Cy Dow"), ("j/x", None)], "key string, author string")
    lead, co = rel.lead_coauthor_split(rel.authorship(df))
    assert rows(lead) == [("j/Bell99", "Ann Bell")] and rows(co) == [("j/Bell99", "Cy Dow")]


def test_iri_and_class(spark):
    df = spark.createDataFrame([("a b-c'\"_\\]^`~", "WorkGroup"), ("z", "Other")], "i string, t string")
    found = df.select(cells.mint_iri("i", "n/"), cells.class_iri("t", "n/", ["ExpertGroup"], {"WorkGroup": "ExpertGroup"})).collect()
    assert tuple(found[0]) == ("n/a_b_c________", "n/ExpertGroup") and tuple(found[1]) == ("n/z", None)


def test_citation_operators(spark, rows):
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c")], "key string, cite string")
    assert rows(rel.citation_counts(pairs)) == [(2, 2, 3)]
    records = spark.createDataFrame([("x", k) for k in "abcd"], "record_type string, key string")
    assert rows(rel.citation_subset(records, pairs), "key") == [("a",), ("b",), ("c",)]


def test_concat_values_gives_consecutive_parts(spark):
    data = [("hot", f"v{i:03}") for i in range(300)] + [("small", "b"), ("small", "a"), ("small", "a"), ("none", None)]
    df = spark.createDataFrame(data, "g string, v string").repartition(5)
    for size in (1, 7, 100, 1000):
        found = rel.concat_values(df, "g", "v", separator=",", values_per_part=size).collect()
        for group, want in (("small", ["a", "b"]), ("hot", [f"v{i:03}" for i in range(300)])):
            parts = sorted((r["part"], r["values"]) for r in found if r["g"] == group)
            assert [p for p, _ in parts] == list(range(-(-len(want) // size)))
            assert ",".join(v for _, v in parts) == ",".join(want)
            assert all(len(v.split(",")) == size for _, v in parts[:-1])
        assert {r["g"] for r in found} == {"small", "hot"}


def test_year_needs_a_plain_number(spark):
    cases = {"2001": 2001, " 2001 ": 2001, "2001.0": 2001, "2001d": None, "2001f": None, "0x7D1": None, "1e3": 1000, "NaN": None, "": None, None: None}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "y string, want int")
    assert df.filter(~F.col("want").eqNullSafe(to_year("y"))).count() == 0
    raw = spark.createDataFrame([("b", "2001"), ("b", " 2001 "), ("b", "x"), ("b", "y"), ("b", "y")], "b string, year string")
    assert sorted(r["year"] or 0 for r in rel.coerce_year(raw, ["b", "year"]).collect()) == [0, 0, 2001, 2001]
    assert [r["year"] for r in rel.coerce_year(raw, ["b", "year"], bad_year="drop").collect()] == [2001]


def test_right_outer_join_keeps_every_right_row(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "k long, v string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k long, w string")
    found = {tuple(r) for r in rel.right_outer_join(left, right, "k").select("k", "v", "w").collect()}
    assert found == {(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (None, None, "z")}


def test_lookup_with_hot_key_equals_join(spark, rows):
    facts = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (3, 1), (None, 2)], "k long, n long")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert [k for k, _ in hot_keys(facts, "k", min_rows=10)] == [1]
    for how in ("inner", "left"):
        a = collections.Counter(tuple(r) for r in lookup(facts, dim, "k", how, min_rows=10).select("k", "n", "v").collect())
        b = collections.Counter(tuple(r) for r in facts.join(dim, "k", how).select("k", "n", "v").collect())
        assert a == b


def test_dense_ids_are_gapless_and_ordered(spark, rows):
    df = spark.range(997).select(F.format_string("k%04d", F.col("id")).alias("k")).repartition(7)
    assert rows(dense_ids(df, ["k"], start=5)) == [(i + 5, f"k{i:04}") for i in range(997)]


def test_relation_normalize(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, None)], "rec long, v string")
    nodes, edges = relation_normalize(df, "v", "rec", start=10)
    assert rows(nodes) == [(10, "a"), (11, "b")] and rows(edges) == [(1, 10), (1, 11), (2, 10)]
    hashed_nodes, hashed_edges = relation_normalize(df, "v", "rec", ids="hash")
    joined = hashed_edges.join(hashed_nodes, F.col("end_id") == F.col("node_id"))
    assert rows(joined, "start_id", "value") == [(1, "a"), (1, "b"), (2, "a")]


def test_reviewers_are_distinct_foreign_and_repeatable(spark):
    data = [(f"p{i}", f"a{j}") for i in range(40) for j in (i % 5, 5 + i % 3)]
    df = spark.createDataFrame(data, "key string, author string")
    first = [tuple(r) for r in assign_reviewers(df, 3, batch=2).collect()]
    assert sorted(first) == sorted(tuple(r) for r in assign_reviewers(df, 3, batch=9).collect())
    own, got = collections.defaultdict(set), collections.defaultdict(list)
    for k, a in data:
        own[k].add(a)
    for k, r, _ in first:
        got[k].append(r)
    assert set(got) == set(own)
    for k, chosen in got.items():
        assert len(chosen) == len(set(chosen)) == 3 and not own[k] & set(chosen)


def test_reviewers_where_one_author_holds_nearly_all_rows(spark):
    data = [(f"p{i}", "busy") for i in range(400)] + [(f"p{i}", f"a{i}") for i in range(6)]
    df = spark.createDataFrame(data, "key string, author string")
    got = collections.defaultdict(set)
    for k, r, _ in assign_reviewers(df, 3, row_draws=12).collect():
        got[k].add(r)
    assert len(got) == 400 and all(len(v) == 3 and "busy" not in v for v in got.values())
    assert all(f"a{i}" not in got[f"p{i}"] for i in range(6))


def test_reviewers_when_too_few_others_exist(spark):
    df = spark.createDataFrame([("p", "a"), ("q", "b")], "key string, author string")
    found = assign_reviewers(df, 3)
    assert sorted((r["key"], r["reviewer"]) for r in found.collect()) == [("p", "b"), ("q", "a")]
    assert reviewer_cells(found, "text").filter("textual_description = 'text'").count() == 2


def test_affiliations_cover_every_author_once(spark):
    authors = spark.createDataFrame([(f"a{i % 30}",) for i in range(90)], "author string")
    orgs = spark.createDataFrame([("x",), ("y",), ("x",)], "organization string")
    found = assign_affiliations(authors, orgs).collect()
    assert len({r["author"] for r in found}) == len(found) == 30
    assert {r["organization"] for r in found} == {"x", "y"}


def test_keywords(spark):
    docs = spark.createDataFrame([(1, "Big data and the storage of storage"), (2, "the green apple"), (3, "apple pie")], "id long, t string")
    found = {r["id"]: r["keywords"].split("|") for r in keywords_topk(docs, "id", "t", k=2).collect()}
    assert found[1] == ["big data", "storage"]
    assert found[2] == ["green", "green apple"] and found[3] == ["apple pie", "pie"]


def test_venue_takes_last_mentions_of_whole_text(spark, rows):
    filler = "word " * 3000
    docs = spark.createDataFrame([(1, f"Rome Italy {filler} New York, Peru. Spain"), (2, "Rome only")], "id long, t string")
    names = spark.createDataFrame([("city", "Rome"), ("city", "New York"), ("country", "Italy"), ("country", "Spain"), ("country", "Peru")], "kind string, name string")
    assert rows(venue_last_mention(docs, names, "id", "t", max_words=2)) == [(1, "new york", "spain")]


def test_venue_of_publication(spark, rows):
    pubs = spark.createDataFrame([("e1", "p1"), ("v1", "p2"), ("none", "p3")], "edition_id string, publication_id string")
    proceedings = spark.createDataFrame([("c", "e1"), ("c", "e2")], "conf_id string, edition_id string")
    volumes = spark.createDataFrame([("j", "v1")], "journal_id string, edition_id string")
    assert rows(rel.venue_of_publication(pubs, proceedings, volumes)) == [("p1", "e1", "c"), ("p2", "v1", "j")]


def test_property_graph_merge_and_evolution(spark, rows):
    papers = spark.createDataFrame([("k1", "T", "B", 2001, "x|y"), ("k2", "U", "B", None, "x")], "key string, title string, booktitle string, year int, keywords string")
    lead = spark.createDataFrame([("k1", "Ann"), ("k3", "Cy")], "key string, author string")
    co = spark.createDataFrame([("k1", "Bo")], "key string, author string")
    graph = pg.assemble(pg.load_conference_papers(papers), pg.load_authors(lead, co))
    nodes = graph.nodes.filter("label = 'Paper'").select("key", "title", "year")
    assert sorted(map(str, map(tuple, nodes.collect()))) == ["('k1', 'T', '2001')", "('k2', 'U', None)", "('k3', None, None)"]
    assert graph.nodes.filter("label = 'Conference'").count() == 1  # a null year is no identity
    assert graph.edges.filter("type = 'HAS'").count() == 1
    assert rows(graph.edges.filter("type = 'WRITES'"), "src", "dst", "is_lead") == [
        ("Author:Ann", "Paper:k1", True), ("Author:Bo", "Paper:k1", False), ("Author:Cy", "Paper:k3", True)]
    reviews = spark.createDataFrame([("k1", "Cy|Nobody", "good"), ("k9", "Cy", "lost")], "key string, reviewer string, textual_description string")
    old = pg.review_edges(spark.createDataFrame([("k2", "Bo")], "key string, reviewer string"), graph.nodes)
    evolved = pg.evolve_reviews(old, reviews, graph.nodes)
    assert {tuple(r) for r in evolved.select("src", "dst", "decision", "textual_description").collect()} == {
        ("Author:Bo", "Paper:k2", None, None), ("Author:Cy", "Paper:k1", "accept", "good")}
    pairs = spark.createDataFrame([("k1", "k2"), ("k1", "gone")], "id string, cite string")
    assert rows(pg.citation_edges(pairs, graph.nodes), "src", "dst") == [("Paper:k2", "Paper:k1")]
    load = pg.affiliation_load(spark.createDataFrame([("Ann", "O"), ("Nobody", "P")], "author string, affiliation string"), graph.nodes)
    assert load.edges.count() == 1 and load.nodes.count() == 2


def test_edge_property_upsert_keeps_old_values(spark):
    old = spark.createDataFrame([("R", "a", "p", "x", None)], "type string, src string, dst string, d string, t string")
    new = spark.createDataFrame([("R", "a", "p", None, "y")], "type string, src string, dst string, d string, t string")
    assert tuple(set_edge_properties(old, new, ["d", "t"]).first()) == ("R", "a", "p", "x", "y")


def test_extractions(spark, rows):
    raw = spark.createDataFrame(
        [("k1", "Data in Rome, Italy", "B", "2001", "1", "J"), ("k2", "None", "B", "n.d.", "1", "J"), ("k2", "None", "B", "n.d.", "1", "J")],
        "key string, title string, booktitle string, year string, volume string, journal string")
    assert rows(bib.extract_conferences(raw)) == [("B", 2001)]
    assert {tuple(r) for r in bib.extract_journals(raw).collect()} == {("J", "1", 2001), ("J", "1", None)}
    names = spark.createDataFrame([("city", "Rome"), ("country", "Italy")], "kind string, name string")
    assert rows(bib.extract_venues(raw, names), "booktitle", "city", "country") == [("B", "rome", "italy")]
    assert bib.extract_conference_papers(raw).count() == 2
    assert bib.extract_journal_papers(raw).columns == ["key", "title", "journal", "year", "volume", "keywords"]


def test_ontology_and_domain_queries(spark, rows):
    triples = tbox_triples(spark, NS)
    assert triples.count() == 96
    assert rows(props_of_domains(triples, [NS + "Author"])) == [(NS + "name",), (NS + "writes",)]
    assert [p.removeprefix(NS) for (p,) in rows(props_of_domains(triples, [NS + "Conference", NS + "Journal"]))] == [
        "cHandledBy", "cRelatedTo", "contains", "has", "jHandledBy", "jRelatedTo"]


def test_triples_form_a_set_and_titles_concatenate(spark, rows):
    tables = {
        "papers": spark.createDataFrame([("p 1", "Enterprise Architectures", None, "FullPaper"), ("p 2", "Brooks Automation", "2001", "Other")], "id string, title string, year string, type string"),
        "authors": spark.createDataFrame([("a-1", "Barbara"), ("a-1", "Barbara")], "author_id string, author_name string"),
        "author_writes_paper": spark.createDataFrame([("a-1", "p 1"), ("a-1", "p 2")], "author_id string, paper_id string"),
        "journals": spark.createDataFrame([("j",), ("j",)], "journal_id string"),
    }
    triples = abox_triples(tables, NS)
    assert triples.count() == 2 + 1 + 1 + 2 + 2 + 1
    assert abox_triples(tables, NS, null_literal="nan").filter("o = 'nan'").count() == 1
    assert rows(author_titles(triples, NS), "author", "titles") == [("Barbara", "Brooks Automation, Enterprise Architectures")]
    assert knowledge_graph(spark, tables, NS).count() == 96 + 9


def test_tasks_of_keywords_follow_the_size_of_the_texts(spark, monkeypatch):
    from paperweave.operators import keywords

    texts = [(n, " ".join(f"w{(n * k) % 37}" for k in range(60))) for n in range(120)] + [(None, "a lone w1"), (3, "w1 twice"), (500, None)]
    docs = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    whole = sorted(keywords.keywords_topk(docs, "id", "text").collect(), key=str)
    parts, cut = [], keywords.cut_lineage
    monkeypatch.setattr(keywords, "cut_lineage", lambda df: parts.append(df.rdd.getNumPartitions()) or cut(df))
    small = keywords.keywords_topk(docs, "id", "text", task_bytes=1000)
    assert sorted(small.collect(), key=str) == whole
    assert parts[0] >= 20


def test_counts_of_terms_stay_by_key(spark):
    """Scores are ranked in the layout that terms were counted in, which is cut by the size of the texts."""
    docs = spark.createDataFrame([(f"k{i % 40}", f"word{i} shared term{i % 7}") for i in range(120)], "id string, text string")
    best = keywords_topk(docs, "id", "text", task_bytes=100)
    assert "hashpartitioning(id" not in best._jdf.queryExecution().executedPlan().toString()
    assert best.rdd.getNumPartitions() > 8 and best.count() == 40


def test_draws_of_reviewers_move_to_their_record_once(spark, monkeypatch):
    df = spark.createDataFrame([(f"p{i}", f"a{j}") for i in range(40) for j in range(i % 4, i % 4 + 3)] + [("big", f"a{j}") for j in range(5)], "key string, author string")
    expected = sorted(tuple(r) for r in assign_reviewers(df, 3, batch=2).collect())
    plans = []

    def cut(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(rows)

    monkeypatch.setattr(entities, "cut_lineage", cut)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(tuple(r) for r in assign_reviewers(df, 3).collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first = next(p for p in plans if "collect_list" in p)
    # Draws and rows by number, both together by record.
    assert first.count("hashpartitioning(") == 3
    # A record with very many authors meets them apart from the others.
    monkeypatch.setattr(entities, "hot_keys", lambda *_: [("big", 5)])
    assert sorted(tuple(r) for r in assign_reviewers(df, 3).collect()) == expected
    reviews = {r["key"]: r["reviewer"] for r in bib.generate_reviews(df.groupBy("key").agg(F.array_join(F.collect_list("author"), "|").alias("author"))).collect()}
    assert reviews == {k: "|".join(r for key, r, _ in sorted(expected, key=lambda x: x[2]) if key == k) for k, _, _ in expected}


def test_iris_are_made_once_a_row_and_compared_without_the_namespace(spark, rows):
    signs = "".join(map(chr, range(1, 128))) + "é👍"
    df = spark.createDataFrame([(signs, "Poster"), ("a b", None)], "id string, type string")
    made = {r[0] for r in df.select(mint_iri("id", "n/")).collect()}
    assert made == {"n/" + s.translate(str.maketrans(dict.fromkeys(string.punctuation + " ", "_"))) for s in (signs, "a b")}
    papers = df.select("id", F.lit("t").alias("title"), F.lit(None).cast("string").alias("year"), "type")
    found = kg.abox_triples({"papers": papers.union(papers)}, "http://ns/")
    assert sorted((r["p"], r["o"], r["o_is_literal"]) for r in found.collect()) == [
        ("http://ns/title", "t", True), ("http://ns/title", "t", True), (RDF_TYPE, "http://ns/Poster", False)
    ]
    assert found.exceptAll(kg.abox_rows({"papers": papers}, "http://ns/")).isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [line for line in plan if "Generate explode" in line]
    assert made and not any("translate(" in line or "regexp_replace(" in line for line in made)
    assert not any("http://ns/" in line for line in made + [line for line in plan if "HashAggregate" in line])


def test_edges_of_each_kind_are_written_and_the_papers_let_go(spark, tmp_path):
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(k, f"NATION_{k}", 0) for k in range(25)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string",
                   [(k, k % 7, "FOP"[k % 3], f"199{k % 4}-0{1 + k % 9}-01", f"{1 + k % 5}-SOME") for k in range(40)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int", [(k, k % 6, 1 + k % 7) for k in range(40)]),
    }
    for name, (schema, data) in tables.items():
        frame = spark.createDataFrame(data, schema)
        if name == "orders":
            frame = frame.withColumn("o_orderdate", F.to_date("o_orderdate"))
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    scratch = Path(shared_folder(spark).removeprefix("file:"), "scratch")
    before = set(scratch.iterdir()) if scratch.exists() else set()
    edges = driver_queries.edges_all(spark, str(tmp_path))
    new = {p.name.rpartition("-")[0] for p in set(scratch.iterdir()) - before}
    assert {"cited", "reviews", "graph-edges"} <= new and "papers" not in new
    kinds = {r["type"]: r["count"] for r in edges.groupBy("type").count().collect()}
    assert kinds["REVIEWS"] == 3 * 40 and kinds["CITED_BY"] > 0 and {"WRITES", "HAS", "MENTIONS", "IS_AFFILIATED_TO"} <= set(kinds)
