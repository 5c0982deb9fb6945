"""Chi-square divergence of the word use of sources, group against group and group against language.

All pairs of groups meet in a cube: a task owns a cell (group block, group block, term block), gets
copies of the two slices of shares it needs, and gives out a partial sum for each pair; partial sums
are added along the term axis. So no task holds a whole vocabulary or all groups, and
a slice travels once for each block of groups, not once for each group. All arithmetic
is in whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, sliced, stored

TERM = re.compile(rb"[a-z\x80-\xff]+")  # after lower-casing: every run of letters A-Z and signs beyond ASCII
SLICE = 1 << 22  # bytes of a text that are cut into words at a time
HELD = 600_000  # terms of groups that a task holds before it hands them on
HANDED = 20_000
UNIT = 1_000_000_000


def _words(text: bytes):
    """Terms of a text, slice by slice; a slice ends where a term ends."""
    start = 0
    while start < len(text):
        end = start + SLICE
        across = TERM.match(text, end) if end < len(text) else None
        end = across.end() if across else end
        yield TERM.findall(text, start, end)
        start = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (lang, source, text) to ``(lang, source, term, n, docs)``, added up within the task; an empty term names a group."""
    counts: dict = defaultdict(Counter)
    holders: dict = defaultdict(Counter)
    held = 0

    def out():
        for (lang, source), terms in counts.items():
            names, docs = [b"", *terms], holders[lang, source]
            for start in range(0, len(names), HANDED):
                part = names[start : start + HANDED]
                n, d = ([kind[t] for t in part] for kind in (terms, docs))  # a Counter gives 0 for the empty term
                columns = [pa.array([lang]).take(pa.array([0] * len(part))), pa.array([source]).take(pa.array([0] * len(part)))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(part, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
        counts.clear()
        holders.clear()

    for batch in sliced(batches, 256):
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            group = lang, source
            terms, docs = counts[group], holders[group]
            held -= len(terms)
            seen: set = set()
            for words in _words(text.lower()):
                terms.update(words)
                seen.update(words)
            docs.update(seen)
            held += len(terms)
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def _share(n, total, size):
    """1 + floor(10^9 (n + 1) / (total + size)), exact beyond 64 bits on the way."""
    return F.expr(f"1 + (cast({UNIT} as decimal(11,0)) * cast({n} + 1 as decimal(20,0))) div cast({total} + {size} as decimal(20,0))")


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term in each group; the term '' names the group.

    Null lang, source and text count as ''. A row is a document, whatever its id.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    texts = docs.select(fields[0].alias("lang"), fields[1].alias("source"), fields[2].cast("binary").alias("text"))
    found = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _cell(group: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of a cell; rows without a term name its groups and their share of an absent term."""
    lang, p, g, size, base = (group.column(c).to_numpy() for c in ("lang", "p", "g", "size", "base"))
    term, name = (group.column(c).combine_chunks().dictionary_encode() for c in ("term", "source"))
    at, of = term.indices.fill_null(-1).to_numpy(), name.indices.to_numpy()
    order = np.flatnonzero(at < 0)
    order = order[np.argsort(of[order])]  # the row that names a group, by the group's code
    sources, absent, side = name.dictionary, p[order], g[order]
    shares = np.repeat(absent[:, None], n_terms := len(term.dictionary), axis=1)
    shares[of[at >= 0], at[at >= 0]] = p[at >= 0]
    one_block = group.column("i")[0] == group.column("j")[0]
    whole = np.where(base[order], size[order], 0)
    pairs, values = [], []
    for b in range(len(sources)):
        asks = np.flatnonzero(np.arange(len(sources)) != b if one_block else side != side[b])
        away = (absent[asks] - absent[b]) ** 2 // absent[b]
        values.append(((shares[asks] - shares[b]) ** 2 // shares[b]).sum(axis=1) + (whole[b] - n_terms) * away)
        pairs.append(np.stack([asks, np.full(len(asks), b)]))
    left, right = np.concatenate(pairs, axis=1)
    columns = [pa.array([lang[0]] * len(left), pa.string()), sources.take(pa.array(left)), sources.take(pa.array(right))]
    return pa.table([*columns, pa.array(np.concatenate(values), pa.int64())], names=["lang", "source", "item", "value"])


def divergences(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = 3,
    top_terms: int = 200,
    groups_in_block: int = 64,
    terms_in_block: int = 4096,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each (lang, source) group differs from the others of its language.

    Part ``pair``: the divergence from each other source, over all terms that ``least_docs`` documents of the language
    hold. Part ``term``: the ``top_terms`` terms that the group uses more than its language does. Larger values come first,
    ties by item. Null lang, source and text count as ''. Groups without terms take part; a language without kept terms
    gives pairs of value 0. Repeated rows count as often as they occur, texts of any length are read whole,
    an empty table gives an empty result, and other columns are not read.
    """
    ship(docs.sparkSession)
    counts = stored(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("held"))
    kept = stored(kept.filter((F.col("held") >= least_docs) & (F.col("term") != "")).drop("held"), "kept-terms")
    used = stored(counts.drop("docs").join(kept, ["lang", "term"]), "used-terms")

    langs = kept.groupBy("lang").agg(F.count("*").alias("size"), F.sum("total").alias("all"))
    named = counts.filter("term = ''").select("lang", "source")
    here = named.groupBy("lang").agg(F.ceil(F.count("*") / groups_in_block).cast("int").alias("blocks"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = named.join(sums, ["lang", "source"], "left").join(here.join(langs, "lang", "left"), "lang").fillna(0, ["own", "size", "all"])
    groups = groups.withColumn("p0", F.when(F.col("size") > 0, _share(0, "own", "size")).otherwise(1))
    groups = groups.withColumn("g", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    slices = F.greatest(F.ceil(F.col("size") / terms_in_block), F.lit(1)).cast("int")
    groups = stored(groups.withColumn("slices", slices), "groups")

    shares = used.join(groups, ["lang", "source"]).withColumn("p", _share("n", "own", "size"))
    shares = stored(shares.withColumn("q", _share("total", "all", "size")), "shares")

    by_rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= top_terms)

    others = F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    cell = [F.least("g", "other").alias("i"), F.greatest("g", "other").alias("j"), "t"]
    rows = ["lang", *cell, "source", "g", "term", "p", "size", "base"]
    slice_of = F.pmod(F.xxhash64("term"), F.col("slices")).cast("int")
    told = shares.withColumn("t", slice_of).withColumn("base", F.lit(False)).select("*", others).select(*rows)
    own = groups.select("*", F.explode(F.expr("sequence(0, slices - 1)")).alias("t")).select("*", others)
    own = own.withColumns({"term": F.lit(None).cast("string"), "p": F.col("p0"), "base": F.col("t") == 0}).select(*rows)
    schema = "lang string, source string, item string, value long"
    partial = told.union(own).groupBy("lang", "i", "j", "t").applyInArrow(_cell, schema)
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_rank))

    parts = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, x in (("pair", pairs), ("term", terms))]
    return parts[0].union(parts[1])
