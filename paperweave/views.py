"""The driver's tables seen as a trade graph and as a bibliography."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.cells import split_cell
from .session import scratch_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _id(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _trade_hops(spark: SparkSession, sf: str, hop, closed: bool) -> DataFrame:
    """A row for each link of the tables, as ``hop(kind, source key, destination key, weight)`` gives it."""

    def hops(name: str, *kinds) -> DataFrame:
        # All edge kinds of a table come from one scan.
        return table(spark, sf, name).select(F.explode(F.array(*kinds)).alias("h")).select("h.*")

    rows = (
        hops("orders", hop("CO", "o_custkey", "o_orderkey"))
        .unionByName(
            hops(
                "lineitem",
                hop("OP", "l_orderkey", "l_partkey", "l_quantity"),
                hop("PS", "l_partkey", "l_suppkey", "l_linenumber"),
            )
        )
        .unionByName(hops("supplier", hop("SN", "s_suppkey", "s_nationkey")))
    )
    if closed:
        rows = rows.unionByName(hops("customer", hop("NC", "c_nationkey", "c_custkey")))
    return rows


def trade_edges(spark: SparkSession, sf: str, closed: bool = True) -> DataFrame:
    """customer → order → part → supplier → nation (→ customer when ``closed``).

    Parallel edges collapse on the numeric keys; text ids are made afterwards.
    """

    def hop(kind: str, src: str, dst: str, weight: str = "1"):
        return F.struct(
            F.lit(kind).alias("kind"),
            *[F.expr(f"CAST({e} AS BIGINT)").alias(n) for n, e in (("a", src), ("b", dst), ("weight", weight))],
        )

    rows = _trade_hops(spark, sf, hop, closed)
    cheapest = rows.groupBy("kind", "a", "b").agg(F.min("weight").alias("weight"))
    return cheapest.select(
        F.concat(F.substring("kind", 1, 1), F.col("a")).alias("src"),
        F.concat(F.substring("kind", 2, 1), F.col("b")).alias("dst"),
        "weight",
    )


# Kinds of trade vertices by the number that stands in the low bits of a numbered id.
_TRADE_KINDS = "COPSN"
_KIND_BITS = 3
_TRADE_KEYS = {
    "orders": ["o_custkey", "o_orderkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "customer": ["c_nationkey", "c_custkey"],
}


def trade_keys_fit(spark: SparkSession, sf: str) -> bool:
    """Whether every key of the trade graph leaves room for its kind in 64 bits."""
    sides = None
    for name, columns in _TRADE_KEYS.items():
        keys = [F.col(c).cast("long") for c in columns]
        side = table(spark, sf, name).agg(F.min(F.least(*keys)).alias("low"), F.max(F.greatest(*keys)).alias("high"))
        sides = side if sides is None else sides.unionByName(side)
    low, high = sides.agg(F.min("low"), F.max("high")).first()
    room = 1 << (62 - _KIND_BITS)
    return low is None or (-room <= low and high < room)


def trade_number(kind: str, key: int) -> int:
    """The number of one vertex."""
    return (key << _KIND_BITS) + _TRADE_KINDS.index(kind)


def trade_name(column: str) -> Column:
    """Number → text id as in ``trade_edges``."""
    place = F.col(column).bitwiseAND(F.lit((1 << _KIND_BITS) - 1)).cast("int") + 1
    return F.concat(F.substr(F.lit(_TRADE_KINDS), place, F.lit(1)), F.shiftright(column, _KIND_BITS).cast("string"))


def trade_edges_numbered(spark: SparkSession, sf: str, closed: bool = True) -> DataFrame:
    """``trade_edges`` with numbers for ids (see ``trade_keys_fit``) and parallel edges as they come."""

    def number(kind: str, key: str) -> Column:
        return (F.expr(f"CAST({key} AS BIGINT)") * (1 << _KIND_BITS) + _TRADE_KINDS.index(kind)).cast("long")

    def hop(kind: str, src: str, dst: str, weight: str = "1"):
        return F.struct(
            number(kind[0], src).alias("src"), number(kind[1], dst).alias("dst"), F.expr(f"CAST({weight} AS BIGINT)").alias("weight")
        )

    return _trade_hops(spark, sf, hop, closed)


def trade_vertices(spark: SparkSession, sf: str) -> DataFrame:
    """``id, value``: money columns in cents, nations 0."""

    def side(name: str, prefix: str, key: str, money: str | None) -> DataFrame:
        value = F.round(F.col(money) * 100).cast("long") if money else F.lit(0).cast("long")
        return table(spark, sf, name).select(_id(prefix, key).alias("id"), value.alias("value"))

    return (
        side("customer", "C", "c_custkey", "c_acctbal")
        .unionByName(side("orders", "O", "o_orderkey", "o_totalprice"))
        .unionByName(side("part", "P", "p_partkey", "p_retailprice"))
        .unionByName(side("supplier", "S", "s_suppkey", "s_acctbal"))
        .unionByName(side("nation", "N", "n_nationkey", None))
    )


# The bibliography view.  Inputs are plain row-local projections written once as
# SQL that both Spark and the checking database run; operators are applied on top.


def _key(number: str) -> str:
    return f"concat('orders/', lpad(CAST({number} % 97 AS STRING), 9, '0'), '/', CAST({number} AS STRING))"


def _clerk(number: str) -> str:
    return f"concat('Clerk ', lpad(CAST({number} % 97 AS STRING), 9, '0'))"


def _customer(number: str) -> str:
    return f"concat('Customer ', lpad(CAST({number} AS STRING), 9, '0'))"


_VOLUME_EDITION = "concat(journal, '/', trim(year), '/', volume)"
_PROCEEDING = "concat(booktitle, '/', trim(year))"

BIBLIOGRAPHY = {
    # A record per order: two to three authors, a title naming a nation and
    # mostly a region, a year that is padded or unreadable in places.
    "papers": f"""
        SELECT {_key('o_orderkey')} AS key, o_orderkey AS num, o_custkey AS custkey,
               CASE WHEN o_orderkey % 2 = 0 THEN 'inproceedings' ELSE 'article' END AS record_type,
               concat('The ', lower(substr(o_orderpriority, 3)),
                      CASE WHEN o_orderkey % 4 = 0 THEN ' data storage' ELSE ' trade' END,
                      ' meeting ', CAST(o_custkey % 40 AS STRING), ' in ',
                      replace(lower(n_name), '_', ' '), ' for ',
                      CASE WHEN o_orderkey % 7 = 0 THEN 'nobody' ELSE lower(r_name) END) AS title,
               CASE WHEN o_orderkey % 11 = 0 THEN 'n.d.'
                    WHEN o_orderkey % 5 = 0 THEN concat('  ', CAST(year(o_orderdate) AS STRING), ' ')
                    ELSE CAST(year(o_orderdate) AS STRING) END AS year,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS booktitle,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('J ', o_orderpriority) END AS journal,
               CAST(month(o_orderdate) AS STRING) AS volume,
               CASE WHEN o_orderkey % 3 = 0
                    THEN concat({_clerk('o_orderkey')}, '|', {_customer('o_custkey')}, '|', {_customer('(o_custkey + 1)')})
                    ELSE concat({_clerk('o_orderkey')}, '|', {_customer('o_custkey')}) END AS author,
               CASE o_orderstatus WHEN 'F' THEN 'FullPaper' WHEN 'O' THEN 'ShortPaper'
                                  WHEN 'P' THEN 'DemoPaper' END AS type,
               substr(o_orderpriority, 1, 1) AS digit
        FROM {{orders}}
        JOIN {{nation}} ON n_nationkey = o_custkey % 25
        JOIN {{region}} ON r_regionkey = n_regionkey""",
    "citations": f"""
        SELECT {_key('l_orderkey')} AS id,
               CASE WHEN l_linenumber = 7 THEN '...' ELSE {_key('l_partkey * 8')} END AS cite
        FROM {{lineitem}}""",
    "gazetteer": """
        SELECT 'city' AS kind, replace(n_name, '_', ' ') AS name FROM {nation}
        UNION ALL SELECT 'country' AS kind, r_name AS name FROM {region}""",
    "organizations": "SELECT n_name AS organization FROM {nation}",
    "kg_papers": "SELECT key AS id, title, trim(year) AS year, type, booktitle AS publication FROM {papers}",
    "kg_keyword": """
        SELECT DISTINCT concat('kw', substr(p_brand, 7)) AS id, p_brand AS words FROM {part}""",
    "kg_conf_area": """
        SELECT DISTINCT booktitle AS conf_id, concat('kw', digit) AS area_id FROM {papers}
        WHERE record_type = 'inproceedings'""",
    "kg_conferences": """
        SELECT DISTINCT booktitle AS conf_id,
               CASE digit WHEN '1' THEN 'Workshop' WHEN '2' THEN 'Symposium' WHEN '3' THEN 'WorkGroup'
                          WHEN '4' THEN 'RegularConference' ELSE 'Other' END AS type
        FROM {papers} WHERE record_type = 'inproceedings'""",
    "kg_has_proceedings": f"""
        SELECT DISTINCT booktitle AS conf_id, {_PROCEEDING} AS edition_id
        FROM {{papers}} WHERE record_type = 'inproceedings' AND booktitle IS NOT NULL
        UNION ALL SELECT DISTINCT booktitle AS conf_id, concat(booktitle, '/planned') AS edition_id
        FROM {{papers}} WHERE booktitle IS NOT NULL""",
    "kg_contains_volume": f"""
        SELECT DISTINCT journal AS journal_id, {_VOLUME_EDITION} AS edition_id
        FROM {{papers}} WHERE record_type = 'article' AND journal IS NOT NULL""",
    "kg_cHandledBy": """
        SELECT DISTINCT concat('Chair ', CAST(custkey % 25 AS STRING)) AS chair_id, booktitle AS conf_id
        FROM {papers} WHERE record_type = 'inproceedings'""",
    "kg_jHandledBy": """
        SELECT DISTINCT concat('Editor ', CAST(custkey % 25 AS STRING)) AS editor_id, journal AS journal_id
        FROM {papers} WHERE record_type = 'article'""",
    "kg_journal_area": """
        SELECT DISTINCT journal AS journal_id, concat('kw1', digit) AS area_id FROM {papers}
        WHERE record_type = 'article'""",
    "kg_paper_area": f"""
        SELECT {_key('l_orderkey')} AS paper_id, concat('kw', substr(p_brand, 7)) AS area_id
        FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey""",
    "kg_reviews": f"""
        SELECT concat('rev', CAST(d.doc_id AS STRING)) AS review_id, {_key('d.doc_id')} AS paper_id,
               CASE WHEN quality = 1 THEN 'accept' ELSE 'reject' END AS decision, text AS review_text,
               concat('reviewer', CAST(d.doc_id % 100 AS STRING)) AS author_id
        FROM {{documents}} AS d JOIN {{labels}} AS l ON l.doc_id = d.doc_id""",
    "kg_journals": "SELECT journal AS journal_id FROM {papers} WHERE record_type = 'article'",
    "kg_has_publication": f"""
        SELECT CASE WHEN record_type = 'article' THEN {_VOLUME_EDITION} ELSE {_PROCEEDING} END AS edition_id,
               key AS publication_id
        FROM {{papers}} WHERE booktitle IS NOT NULL""",
    "kg_assignments": """
        SELECT concat('Chair ', CAST(s_nationkey AS STRING)) AS responsible_id, s_name AS reviewer
        FROM {supplier}""",
}

_TABLES = ["nation", "region", "orders", "lineitem", "part", "supplier", "documents", "labels"]


def bibliography(
    spark: SparkSession, sf: str, name: str, papers: DataFrame | None = None
) -> DataFrame:
    """One of the ``BIBLIOGRAPHY`` inputs over the driver's tables."""
    sql = BIBLIOGRAPHY[name]
    inputs = {t: table(spark, sf, t) for t in _TABLES if f"{{{t}}}" in sql}
    if "{papers}" in sql:
        inputs["papers"] = papers if papers is not None else bibliography(spark, sf, "papers")
    return spark.sql(sql, **inputs)


def stored_papers(spark: SparkSession, sf: str) -> DataFrame:
    """The paper records written out once, a folder per record type.

    Jobs that read them many times then get pruned columns and partitions
    instead of repeating the joins behind them.
    """
    path = scratch_path(spark, "papers")
    bibliography(spark, sf, "papers").write.partitionBy("record_type").parquet(path)
    papers = spark.read.parquet(path)
    papers.stored_at = path
    return papers


def knowledge_tables(spark: SparkSession, sf: str, papers: DataFrame | None = None) -> dict[str, DataFrame]:
    """Input tables of the triple mapping."""
    papers = stored_papers(spark, sf) if papers is None else papers
    names = [n.removeprefix("kg_") for n in BIBLIOGRAPHY if n.startswith("kg_")]
    tables = {n: bibliography(spark, sf, f"kg_{n}", papers) for n in names}
    # Duplicates need no shuffle here: the triple set is deduplicated once at the end.
    pairs = papers.select("key", F.explode(split_cell("author")).alias("author"))
    tables["author_writes_paper"] = pairs.select(
        F.col("author").alias("author_id"), F.col("key").alias("paper_id")
    )
    tables["authors"] = pairs.select(
        F.col("author").alias("author_id"), F.col("author").alias("author_name")
    )
    return tables


def typed_cells(spark: SparkSession, sf: str) -> DataFrame:
    """``record_type, column, values`` from columns of mixed content, one scan per table."""

    def cells(name: str, **columns: str) -> DataFrame:
        rows = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.expr(e).alias("values"))
                for c, e in columns.items()
            ]
        )
        spread = table(spark, sf, name).select(F.explode(rows).alias("c"))
        return spread.select(F.lit(name).alias("record_type"), "c.column", "c.values")

    def one(e: str) -> str:
        return f"array(CAST({e} AS STRING))"

    return (
        cells("orders", **{c: one(e) for c, e in TYPED_COLUMNS["orders"].items()})
        .unionByName(cells("part", **{c: one(e) for c, e in TYPED_COLUMNS["part"].items()}))
        .unionByName(cells("events", **{c: one(e) for c, e in TYPED_COLUMNS["events"].items()}))
        .unionByName(cells("part", tags="array(p_brand, p_type)"))
    )


TYPED_COLUMNS = {
    "orders": {
        "o_orderkey": "o_orderkey",
        "o_totalprice": "o_totalprice",
        "placed": "o_orderdate",
        "placed_mixed": "CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)"
        " ELSE CAST(o_orderdate AS STRING) END",
        "large": "CASE WHEN o_totalprice > 400000 THEN 'TRUE' ELSE '' END",
        "negated": "-o_custkey",
        "empty": "''",
    },
    "part": {
        "p_name": "p_name",
        "size_or_price": "CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS STRING)"
        " ELSE CAST(p_retailprice AS STRING) END",
        "size_or_flag": "CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS STRING) ELSE 'true' END",
        "bad_date": "CASE WHEN p_partkey % 2 = 0 THEN '2020-13-40' ELSE '2020-01-02' END",
    },
    "events": {"user_id": "user_id", "ts": "ts", "props": "props", "day": "CAST(ts AS DATE)"},
}


def bibliography_xml(spark: SparkSession, sf: str) -> DataFrame:
    """``value``: every paper as an XML record with attributes, repeats and mixed content.

    Some are followed by a comment that holds whole records, some have tags of records in a CDATA section.
    """
    papers = bibliography(spark, sf, "papers")
    authors = F.transform(
        F.split("author", "[|]"),
        lambda a: F.concat(F.lit('<author orcid="'), F.element_at(F.split(a, " "), -1), F.lit('">'), a, F.lit("</author>")),
    )

    def element(name: str, column) -> object:
        return F.concat(F.lit(f"<{name}>"), column, F.lit(f"</{name}>"))

    def maybe(condition, text) -> object:
        return F.when(condition, text).otherwise(F.lit(""))

    is_article = F.col("record_type") == "article"
    cited = F.expr(_key("CAST(floor(num / 2) AS BIGINT)"))
    return papers.select(
        F.concat(
            F.lit("<"), "record_type", F.lit(' key="'), "key", F.lit('" mdate="2020-01-02">\n'),
            F.array_join(authors, "\n"),
            F.lit("\n<title>R&amp;D "), "title", F.lit(" <i>draft</i> text</title>"),
            element("year", F.trim("year")),
            maybe(F.col("journal").isNotNull() & is_article, element("journal", F.coalesce("journal", F.lit("")))),
            maybe(F.col("booktitle").isNotNull() & ~is_article, element("booktitle", F.coalesce("booktitle", F.lit("")))),
            maybe(F.col("num") % 9 == 0, F.lit("<ee/><note><![CDATA[see </article> <inproceedings key='x'> & <!-- more]]></note>")),
            element("cite", cited),
            maybe(F.col("num") % 10 == 0, F.lit("\n<cite>...</cite>")),
            F.lit("</"), "record_type", F.lit(">"),
            maybe(F.col("num") % 14 == 0, F.lit('\n<!-- <article key="c/1"><title>c</title></article>\n<article key="c/2"><author>c</author></article> -->')),
        ).alias("value")
    )
