import pathlib
import random

import pytest

from pyspark.sql import functions as F

from paperweave.functions.value_types import infer_column_types, typed_headers, value_type
from paperweave.plans.bibliography import xml_to_tables
from paperweave.sources import delimited, graph_files
from paperweave.sources import xml_records as xml

DUMP = """<?xml version="1.0"?>
<!DOCTYPE dump SYSTEM "x.dtd">
<dump>
<!-- <article key="no"><title>commented</title></article> -->
 <article key="a/1" mdate="2020-01-02"><author orcid="1">Ann B</author><author>Cy D</author>
  <title>T <i>x</i> y</title><year>2001</year><cite>b/2</cite><cite>...</cite></article>
 <book key='k>1'><title>Caf&#233; &amp; R&#x26;D &uuml; &nope;</title><note/><ee type="x"></ee></book>
 <article key="b/2"><author>Z</author><title><![CDATA[a < b & c]]></title></article>
 <article><title/></article>
</dump>
"""


def dump(tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(DUMP)
    return str(path)


def cells(record):
    found = {}
    for c in record["cells"]:
        found.setdefault(c["column"], []).append(c["value"])
    return found


def test_xml_cells(spark, tmp_path):
    for separator in (None, "</article>"):
        records = xml.read_xml_records(spark, dump(tmp_path), ["article", "book"], separator, xml.html_entities())
        by_key = {cells(r)["key"][0]: (r["record_type"], cells(r)) for r in records.collect()}
        assert set(by_key) == {"a/1", "b/2", "k>1"}
        assert by_key["a/1"][1] == {
            "key": ["a/1"], "mdate": ["2020-01-02"], "author": ["Ann B", "Cy D"], "author-orcid": ["1"],
            "title": ["T "], "i": ["x"], "year": ["2001"], "cite": ["b/2", "..."],
        }
        assert by_key["b/2"][1]["title"] == ["a < b & c"]
        # Empty elements give no cell, nor do their attributes.
        assert by_key["k>1"] == ("book", {"key": ["k>1"], "title": ["Café & R&D ü &nope;"]})


def test_self_closing_and_nested_names(spark, tmp_path):
    text = (
        '<r><article key="x"/><article key="y"><title>Y</title></article><book key="z" note="a>b" />'
        '<article key="w"><book>nested</book><title>&#x0000041;&#000066;</title></article><article/></r>'
    )
    (tmp_path / "odd.xml").write_text(text)
    found = [(r["record_type"], cells(r)) for r in xml.read_xml_records(spark, str(tmp_path / "odd.xml"), ["article", "book"]).collect()]
    assert sorted(found, key=str) == sorted([
        ("article", {"key": ["x"]}), ("article", {"key": ["y"], "title": ["Y"]}),
        ("book", {"key": ["z"], "note": ["a>b"]}), ("article", {"key": ["w"], "book": ["nested"], "title": ["AB"]}),
    ], key=str)


def test_records_cut_in_two_are_whole_again(spark, tmp_path):
    text = "<r>" + "<book><t>b</t></book>" * 5 + '<article key="w"><book>nested</book><t>T</t></article></r>'
    (tmp_path / "cut.xml").write_text(text)
    for separator in (None, "</article>", "</book>", "</t>"):
        whole = xml.read_xml_records(spark, str(tmp_path / "cut.xml"), ["article", "book"], separator)
        found = sorted((r["record_type"], sorted(cells(r).items())) for r in whole.collect())
        assert found == [("article", [("book", ["nested"]), ("key", ["w"]), ("t", ["T"])])] + [("book", [("t", ["b"])])] * 5
    (tmp_path / "short.xml").write_text('<r><book><t>b</t></book><book><t>c</t></book><article key="w"><book>nested</book>')
    try:
        xml.read_xml_records(spark, str(tmp_path / "short.xml"), ["article", "book"]).collect()
    except Exception as error:
        assert "ends inside a record" in str(error)
    else:
        raise AssertionError("a record was lost")


ODD_PARTS = [
    "<!-- <article key='c1'><t>x</t></article> <article key='c2'><t>y</t></article> -->",
    "<!-- </article> <![CDATA[ </article> --><article key='A{0}'><t>{0}</t></article>",
    "<article key='B{0}'><t><![CDATA[<!-- </article> <article key='no'><t>z</t></article> & {0}]]></t></article>",
    "<article key='C{0}'><book>in</book><article>inner</article><t>outside</t></article>",
    "<?x </article> <article key='pi'><t>q</t></article> ?><book key='D{0}'><article>in book</article><t>{0}</t></book>",
    "<article key='E{0}'/><book key='F{0}'><t>a --&gt; b ]]&gt;</t></book>",
    "<article key='G{0}'><!-- </article> --><t>g<!-- </article></article> -->h</t></article>",
    "<article key='H{0}'><t>plain</t></article>",
    "<book key='I{0}'><article>1</article><article>2</article><article>3</article><t>i</t></book>",
]


def _read_as_one_text(text, types):
    """The rule in plain Python: a scan that knows what it is in."""
    import re

    plain = re.sub(r"(?s)<!--.*?-->|<!\[CDATA\[(.*?)\]\]>|<\?.*?\?>", lambda m: (m[1] or "").replace("&", "&amp;").replace("<", "&lt;"), text)
    found, tag = [], None
    for m in re.finditer(r"<(/?)(\w+)([^>]*)>", plain):
        if tag is None and not m[1] and m[2] in types:
            if m[3].endswith("/"):
                found.append((m[2], re.search("key='(\\w+)'", m[3])[1]))
            else:
                tag, key = m[2], re.search("key='(\\w+)'", m[3])
        elif tag is not None and m[1] and m[2] == tag:
            found.append((tag, key[1] if key else None))
            tag = None
    return found


def test_states_pass_over_cuts_and_splits(spark, tmp_path, monkeypatch):
    draw = random.Random(11)
    monkeypatch.setattr(xml, "_RANGE_BITS", 2)
    texts = ["<r>" + "\n".join(draw.choice(ODD_PARTS).format(i) for i in range(n)) + "</r>" for n in (400, 60, 1, 0)]
    for k, text in enumerate(texts):
        (tmp_path / f"d{k}.xml").write_text(text)
    want = sorted(x for t in texts for x in _read_as_one_text(t, {"article", "book"}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for separator in (None, "</book>", "</t>"):
            records = xml.read_xml_records(spark, str(tmp_path), ["article", "book"], separator)
            found = [(r["record_type"], cells(r).get("key", [None])[0]) for r in records.collect()]
            assert sorted(found) == want
            texts_of = {cells(r)["key"][0]: cells(r) for r in records.collect() if "key" in cells(r)}
            for key, own in texts_of.items():
                if key[0] == "B":
                    assert own["t"] == [f"<!-- </article> <article key='no'><t>z</t></article> & {key[1:]}"]
                if key[0] == "I":
                    assert own["article"] == ["1", "2", "3"] and own["t"] == ["i"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_comment_longer_than_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(xml, "_RANGE_BITS", 2)
    fake = "<article key='no'><t>x</t></article>" * 300
    text = f"<r><article key='a'><t>1</t></article><!-- {fake} --><article key='b'><t>2<!-- {fake} -->3</t></article></r>"
    (tmp_path / "long.xml").write_text(text)
    found = xml.read_xml_records(spark, str(tmp_path / "long.xml"), ["article"]).collect()
    assert sorted((cells(r)["key"][0], cells(r)["t"][0]) for r in found) == [("a", "1"), ("b", "23")]


def test_steps_are_computed_where_chunks_lie(spark, tmp_path, monkeypatch):
    """Chunks aren't gathered by file before their steps are known: one file's would meet in one task."""
    records = "".join(f'<article key="k{i}"><title>t{i}</title>{"<!-- </article> -->" * (i % 3 == 0)}</article>' for i in range(60))
    (tmp_path / "dump.xml").write_text(f"<r>{records}</r>")
    plans, keep = {}, xml.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(xml, "stored", stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = xml.read_xml_records(spark, str(tmp_path / "dump.xml"), ["article", "book"], "</article>").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(cells(r)["key"][0] for r in found) == sorted(f"k{i}" for i in range(60))
    assert "SortMergeJoin" not in plans["xml-steps"]


def test_a_chunk_without_marks_keeps_other_modes(spark):
    """The short way of chunks that begin and end nothing gives the steps of the long one."""
    lexer = xml._Lexer(["article", "book"])
    texts = ["<article>", "</article>", "<book/> x", "</book><article key='1'>a", "text <b>", "<article></article><book>", "</article> </book>", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "chunk string")
    rows = xml._plain(rows, {"": F.lit(0)}).withColumn("last", lexer.last("plain")).withColumn("code", lexer.code(F.col("end"), "last")).drop("plain", "end", "last")
    short = {r["chunk"]: r["to"] for r in lexer.steps(rows).collect()}
    long = {r["chunk"]: r["to"] for r in lexer._steps(rows, [0, 1, 2, 3]).collect()}
    assert short == long and len(short) == len(texts)


def test_a_rare_type_makes_no_large_chunk(spark, tmp_path):
    text = "<r>" + "".join(f'<article key="{i}"><t>y</t></article>' for i in range(4000)) + '<book key="b"><t>z</t></book></r>'
    (tmp_path / "rare.xml").write_text(text)
    assert xml._commonest_end(spark, str(tmp_path / "rare.xml"), "article|book") == "article"
    chunks = spark.read.option("lineSep", "</article>").text(str(tmp_path / "rare.xml"))
    assert chunks.agg(F.max(F.length("value"))).first()[0] < 100
    found = xml.read_xml_records(spark, str(tmp_path / "rare.xml"), ["book", "article"]).groupBy("record_type").count()
    assert {tuple(r) for r in found.collect()} == {("article", 4000), ("book", 1)}


def test_split_reads_lose_nothing(spark, tmp_path):
    text = "<r>" + "".join(f'<article key="{i}"><t>{"x" * (i % 50)}y</t></article>' for i in range(5000)) + "</r>"
    (tmp_path / "big.xml").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        records = xml.read_xml_records(spark, str(tmp_path / "big.xml"), ["article"])
        assert records.rdd.getNumPartitions() > 3
        keys = records.select(F.element_at("cells", 1)["value"].alias("k"))
        assert keys.count() == 5000 and keys.distinct().count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_discovery_citations_and_wide(spark, tmp_path, rows):
    records = xml.read_xml_records(spark, dump(tmp_path), ["article", "book"])
    found = {r["record_type"]: r["columns"] for r in xml.discover_columns(records).collect()}
    assert found == {
        "article": ["author", "author-orcid", "cite", "i", "key", "mdate", "title", "year"],
        "book": ["key", "title"],
    }
    assert rows(xml.citation_pairs(records)) == [("a/1", "b/2")]
    wide = xml.wide_table(records, "article", ["key", "author", "year"])
    assert {tuple(r) for r in wide.collect()} == {("a/1", "Ann B|Cy D", "2001"), ("b/2", "Z", None)}


def test_reserved_column_is_rejected(spark, tmp_path):
    (tmp_path / "bad.xml").write_text("<r><article><id>1</id></article></r>")
    records = xml.read_xml_records(spark, str(tmp_path / "bad.xml"), ["article"])
    try:
        xml.discover_columns(records).collect()
    except Exception as error:
        assert "reserved column name id" in str(error)
    else:
        raise AssertionError("id must be rejected")


def test_xml_to_tables(spark, tmp_path, rows):
    key = F.element_at(F.filter("cells", lambda c: c["column"] == "key"), 1)["value"]
    made = xml_to_tables(spark, dump(tmp_path), ["article", "book"], relations=["author"], key=key)
    assert rows(made.tables["article"], "id", "key") == [(0, "a/1"), (1, "b/2")]
    assert rows(made.tables["book"], "id", "key") == [(2, "k>1")]
    assert rows(made.nodes["author"]) == [(3, "Ann B"), (4, "Cy D"), (5, "Z")]
    assert rows(made.edges["author"]) == [(0, 3), (0, 4), (1, 5)]
    headers = dict(rows(made.headers))
    assert headers["article"] == (
        "id:integer;author:string[];author-orcid:integer;cite:string[];i:string;key:string;mdate:date;title:string;year:integer"
    )


TYPE_CASES = [
    (["1", "2.5"], ["integer", "float"], "float"),
    (["-5"], ["string"], "string"),
    (["2020-01-02", "2020-01-02 10:00"], ["date", "datetime"], "datetime"),
    (["2020-13-40"], ["string"], "string"),
    (["TRUE", ""], ["boolean", "any"], "boolean"),
    (["1", "true"], ["integer", "boolean"], "string"),
    ([""], ["any"], "string"),
    (["1\n"], ["string"], "string"),
    (["0000-01-01"], ["string"], "string"),
    (["٣"], ["integer"], "integer"),
]


def test_value_and_column_types(spark):
    data = [("t", str(i), v, k) for i, (v, k, _) in enumerate(TYPE_CASES)]
    df = spark.createDataFrame(data, "record_type string, column string, values array<string>, kinds array<string>")
    assert df.filter(F.transform("values", value_type) != F.col("kinds")).count() == 0
    found = {r["column"]: (r["type"], r["is_multi"]) for r in infer_column_types(df).collect()}
    assert found == {str(i): (t, len(v) > 1) for i, (v, _, t) in enumerate(TYPE_CASES)}


def test_headers(spark):
    types = spark.createDataFrame([("a", "y", "integer", False), ("a", "c", "string", True)], "record_type string, column string, type string, is_multi boolean")
    assert typed_headers(types).first()["header"] == "id:integer;c:string[];y:integer"
    assert typed_headers(types, import_style=True).first()["header"] == "a:ID;c:string[];y:int"


def test_tolerant_read(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text('a;b\n1;x\n2;"y;""z"""\n3;p;q\n4;p;q;r\n;\n5\n')
    found = delimited.read_delimited(spark, str(path), "a INT, b STRING")
    assert {tuple(r) for r in found.collect()} == {(1, "x"), (2, 'y;"z"'), (5, None)}
    assert found.count() == 3
    assert delimited.read_delimited(spark, str(path), "a INT, b STRING", max_rows=2).count() == 2


@pytest.mark.parametrize("size", ["64", "300", "100000"])
def test_quoted_breaks_are_read_in_splits(spark, tmp_path, rows, size):
    odd = ['a"b', '"', '""', "x\n\n,y", ",\n\"\n", "\r\n", None, "plain, with", '\n"",""\n', "end\n" * 40]
    lines = ['n,"the\n""text""",m\n', "\n"]
    for n in range(200):
        text = odd[n % len(odd)]
        cell = "" if text is None else '"' + text.replace('"', '""') + '"'
        lines.append(f"{n},{cell},5\" disk{'\r' * (n % 7 == 0)}\n" + "\n" * (n % 11 == 0))
    lines.append('200,"a"b,c\n201\n202,"x\ny",z,surplus\n')
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "broken.csv").write_text("".join(lines), newline="")
    (tmp_path / "in" / "plain.csv").write_text('n,t,m\n300,"p",q\n301,5" x,q')
    expected = [(n, odd[n % len(odd)], '5" disk') for n in range(200)]
    expected += [(200, '"a"b', "c"), (201, None, None), (300, "p", "q"), (301, '5" x', "q")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = delimited.read_delimited(spark, str(tmp_path / "in"), "n INT, t STRING, m STRING", sep=",", quoted_breaks=True)
        assert {r[0]: tuple(r) for r in read.collect()} == {e[0]: e for e in expected}
        assert read.count() == len(expected)
        splits = spark.read.option("lineSep", "\n").text(str(tmp_path / "in")).rdd.getNumPartitions()
        assert (splits > 10) == (int(size) < 1000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_of_lines_compose(spark, tmp_path, monkeypatch):
    from paperweave.sources import quoted_records as q

    monkeypatch.setattr(q, "_RANGE_BITS", 1)
    inner = "".join(f"{k}{',' * (k % 3)}\n" for k in range(25))
    (tmp_path / "in.csv").write_text(f'a;"{inner}"\nb;"x\n"";""\n"\nc;d\n"e\n";"f\n')
    with pytest.raises(ValueError, match="inside of quotes"):
        q.quoted_records(spark, str(tmp_path / "in.csv"), ";", header=False)
    (tmp_path / "in.csv").write_text(f'a;"{inner}"\nb;"x\n"";""\n"\nc;d\n"e\n";"f\n"')
    found = delimited.read_delimited(spark, str(tmp_path / "in.csv"), "k STRING, v STRING", header=False, quoted_breaks=True)
    assert {tuple(r) for r in found.collect()} == {("a", inner), ("b", 'x\n";"\n'), ("c", "d"), ("e\n", "f\n")}


def test_no_quoted_break_needs_no_walk(spark, tmp_path):
    from paperweave.sources.quoted_records import quoted_records

    (tmp_path / "in.csv").write_text('a,b\n"1,2",5" disk\n')
    assert quoted_records(spark, str(tmp_path / "in.csv")) is None
    (tmp_path / "empty.csv").write_text("")
    assert delimited.read_delimited(spark, str(tmp_path / "empty.csv"), "a STRING", sep=",", quoted_breaks=True).count() == 0


def test_typed_header_and_roundtrip(spark, tmp_path):
    (tmp_path / "h.csv").write_text("n:integer;tags:string[];when:date;f:float;s\n")
    df = spark.createDataFrame([(1, ["b", "a"], None, 1.5, 'q"; z'), (2, ["c"], None, None, None)], "n long, tags array<string>, when date, f double, s string")
    delimited.write_delimited(df, str(tmp_path / "out"), header=False)
    back = delimited.read_with_header_file(spark, str(tmp_path / "out"), str(tmp_path / "h.csv"))
    assert back.schema.simpleString() == "struct<n:bigint,tags:array<string>,when:date,f:double,s:string>"
    assert sorted(map(tuple, back.collect())) == [(1, ["a", "b"], None, 1.5, 'q"; z'), (2, ["c"], None, None, None)]


def test_pairs_and_ntriples(spark, tmp_path, rows):
    (tmp_path / "g.txt").write_text("1\tA\tB\nno tab\n2\tC\n")
    assert rows(graph_files.read_pairs(spark, str(tmp_path / "g.txt"))) == [("1", "A\tB"), ("2", "C")]
    triples = spark.createDataFrame([("s", "p", 'a"b\\c\nd', True), ("s", "p", "o", False)], "s string, p string, o string, o_is_literal boolean")
    assert rows(graph_files.ntriples_lines(triples)) == [('<s> <p> "a\\"b\\\\c\\nd" .',), ("<s> <p> <o> .",)]


def test_iris_are_escaped(spark):
    triples = spark.createDataFrame([('a b>c\n👍"', "p", "{x}\\é", False)], "s string, p string, o string, o_is_literal boolean")
    line = graph_files.ntriples_lines(triples).first()["line"]
    assert line == "<a\\u0020b\\u003Ec\\u000A👍\\u0022> <p> <\\u007Bx\\u007D\\u005Cé> ."


def test_typed_tables(spark, tmp_path):
    text = (
        "<d><item key='k1'><n>1</n><n>22</n><f>1</f><day>2020-02-03</day><ok>TRUE</ok><mix>a</mix><big>12345678901234567890</big></item>"
        "<item key='k2'><f>2.5</f><mix>7</mix><at>2020-02-03 10:20</at></item></d>"
    )
    (tmp_path / "typed.xml").write_text(text)
    key = F.try_element_at(xml.cell_values("key"), F.lit(1))
    made = xml_to_tables(spark, str(tmp_path / "typed.xml"), ["item"], key=key)
    table = made.tables["item"]
    assert dict(table.dtypes) == {
        "id": "bigint", "key": "string", "n": "array<decimal(38,0)>", "f": "double", "day": "date", "ok": "boolean",
        "mix": "string", "big": "decimal(38,0)", "at": "timestamp_ntz",
    }
    first, second = table.orderBy("id").collect()
    assert (list(map(int, first["n"])), first["f"], str(first["day"]), first["ok"], first["mix"], int(first["big"])) == ([1, 22], 1.0, "2020-02-03", True, "a", 12345678901234567890)
    assert (second["n"], second["f"], second["mix"], str(second["at"])) == (None, 2.5, "7", "2020-02-03 10:20:00")


def test_quoted_lines_are_neither_written_nor_sorted(spark, tmp_path, rows):
    from paperweave.session import shared_folder

    cells = ["".join(f'""a"", {n} {k}\n' for k in range(300)) for n in range(60)]
    (tmp_path / "in.csv").write_text("\n \nid¦body\n" + "".join(f'{n}¦"{c}"\r\n\n' for n, c in enumerate(cells)), newline="")
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    size = (tmp_path / "in.csv").stat().st_size
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 7))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = delimited.read_delimited(spark, str(tmp_path / "in.csv"), "id INT, body STRING", sep="¦", quoted_breaks=True)
        assert rows(read) == [(n, c.replace('""', '"')) for n, c in enumerate(cells)]
        lines = [r["file"] for r in spark.read.text(str(tmp_path / "in.csv")).select("_metadata.file_block_start", "_metadata.file_path").toDF("block", "file").collect()]
        written = sum(p.stat().st_size for p in set(folder.rglob("*.parquet")) - before)
        assert len(lines) > 18000 and written < size / 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_quoted_lines_end_as_a_walk_over_their_signs_says(spark):
    import pyarrow as pa

    from paperweave.sources.quoted_records import _Lexer

    def walk(line, sep, inside):
        """One sign after another: at a field's beginning, in a plain field, in quotes, after a quote in quotes."""
        place, k = "quoted" if inside else "begin", 0
        while k < len(line):
            sign, wide = (sep, len(sep)) if place != "quoted" and line.startswith(sep, k) else (line[k], 1)
            if place == "quoted":
                place = "after" if sign == '"' else place
            elif sign == sep:
                place = "begin"
            elif sign == '"' and place in ("begin", "after"):
                place = "quoted"
            else:
                place = "plain"
            k += wide
        return place == "quoted"

    draw = random.Random(3)
    for sep in (",", "¦", "||", ";"):
        lines = ["".join(draw.choices(['"', sep, "a", "é", "\r"], k=draw.randrange(9))) for _ in range(3000)]
        from0, from1 = _Lexer(sep).steps(pa.array([x.encode() for x in lines], pa.binary()))
        for line, a, b in zip(lines, from0, from1):
            assert (a, b) == (walk(line, sep, False), walk(line, sep, True)), (sep, line)


def test_ntriples_files_are_compressed_and_bounded(spark, tmp_path, rows):
    n = 3000
    triples = spark.range(n).select(
        F.format_string("http://example.org/papers/%d", "id").alias("s"), F.lit("http://example.org/ontology#title").alias("p"),
        F.format_string('a "title"\nof paper %d', "id").alias("o"), F.lit(True).alias("o_is_literal"),
    )
    lines = rows(graph_files.ntriples_lines(triples))
    for compression, most in (("gzip", 1000), ("none", 10**6)):
        path = tmp_path / compression
        graph_files.write_ntriples(triples.coalesce(1), str(path), compression, most)
        files = list(path.glob("part-*"))
        assert rows(spark.read.text(str(path))) == lines
        assert len(files) == -(-n // most)
        assert compression == "none" or sum(f.stat().st_size for f in files) * 5 < sum(len(x[0]) for x in lines)
    graph_files.write_ntriples(triples, str(tmp_path / "own"))
    assert sum(f.stat().st_size for f in (tmp_path / "own").glob("part-*")) * 5 < sum(len(x[0]) for x in lines)
