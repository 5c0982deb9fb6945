"""Keywords and place mentions from whole texts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import CELL_SEPARATOR, col
from ..session import cut_lineage, planned_shuffles, shuffle_partitions, stored

# Frequent function words that are never keywords.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "in", "is", "it",
    "its", "of", "on", "or", "that", "the", "this", "to", "was", "with",
]

# Vocabulary that ranks before all other terms when a text names it.
VOCABULARY = [
    "edition", "proceeding", "artificial intelligence", "machine learning", "data management",
    "semantic data", "data modeling", "big data", "data processing", "data storage",
    "data querying",
]


def tokens(text: str | Column) -> Column:
    """Lower-case words of a whole text, in order."""
    return F.filter(F.split(F.lower(col(text)), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def ngrams(words: Column, n: int) -> Column:
    """Array of n-word terms; position i holds the term starting at word i.

    A term is null where any of its words is null.
    """
    if n == 1:
        return words
    starts = F.sequence(F.lit(0), F.size(words) - n)

    def term(i: Column) -> Column:
        parts = [F.get(words, i)]
        for k in range(1, n):
            parts += [F.lit(" "), F.get(words, i + k)]
        return F.concat(*parts)

    none = F.array().cast("array<string>")
    return F.when(F.size(words) >= n, F.transform(starts, term)).otherwise(none)


def keywords_topk(
    documents: DataFrame,
    key: str,
    text: str,
    k: int = 5,
    stop_words: list[str] = STOP_WORDS,
    vocabulary: list[str] = VOCABULARY,
    max_words: int = 2,
    digits: int = 9,
    task_bytes: int = 4 << 20,
) -> DataFrame:
    """``key, keywords``: the k best terms of each text as a ``|`` cell.

    Terms of up to ``max_words`` words without stop words are scored by
    tf · ln((1 + N) / (1 + df)); vocabulary terms come first.  Ties go to the
    smaller term.
    """
    seen = documents.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    n_docs = seen["n"]
    # A text's terms take many times its place, so tasks are cut by the texts' size and not by the session's setting alone.
    parts = max(shuffle_partitions(documents.sparkSession), math.ceil((seen["bytes"] or 0) / task_bytes))
    # Texts move once, by key; their terms (several times larger) are then
    # counted where they are, and only the counts meet the term statistics.
    words = (
        documents.select(key, text)
        .repartition(parts, F.col(key))
        .select(key, F.transform(tokens(text), lambda w: F.when(~w.isin(stop_words), w)).alias("words"))
    )
    terms = F.concat(*[ngrams(F.col("words"), n) for n in range(1, max_words + 1)])
    tf = (
        # The outer form keeps Spark from adding a size test that tokenizes twice.
        words.select(key, F.explode_outer(terms).alias("term"))
        .filter("term IS NOT NULL")
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )
    # Written once: the counts are read for the statistics and for the scores, and
    # a join of two written tables can split a term that nearly every text has.
    # The statistics' size is known then: where they are few they come to the counts, which stay by key up to the end.
    with planned_shuffles(documents.sparkSession):  # a fixed layout is known to lie by key when it is read again
        tf = cut_lineage(tf)
    df = stored(tf.groupBy("term").agg(F.count("*").alias("df")), "term-counts")
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df")))
    listed = F.col("term").isin(vocabulary) if vocabulary else F.lit(False)
    scored = tf.join(df, "term").select(
        key, "term", listed.alias("listed"), F.round(F.col("tf") * idf, digits).alias("score")
    )
    order = Window.partitionBy(key).orderBy(F.desc("listed"), F.desc("score"), "term")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    cells = F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda r: r["term"])
    return best.groupBy(key).agg(F.array_join(cells, CELL_SEPARATOR).alias("keywords"))


def venue_last_mention(
    documents: DataFrame,
    gazetteer: DataFrame,
    key: str,
    text: str,
    max_words: int = 1,
) -> DataFrame:
    """``key, city, country``: the last city and the last country a text names.

    ``gazetteer`` has ``kind`` ('city' or 'country') and ``name``.  Texts that
    do not name both are left out.
    """
    words = documents.select(key, tokens(text).alias("words"))
    names = gazetteer.select("kind", F.lower("name").alias("term")).distinct()
    spots = []
    for n in range(1, max_words + 1):
        spots.append(
            words.select(key, F.posexplode_outer(ngrams(F.col("words"), n)).alias("pos", "term"))
            .filter("term IS NOT NULL")
            .select(key, "term", (F.col("pos") + (n - 1)).alias("pos"))
        )
    places = spots[0]
    for more in spots[1:]:
        places = places.unionByName(more)
    # The gazetteer join drops almost all words, so it comes before any grouping.
    hits = places.join(names, "term")
    at = F.struct("pos", F.length("term").alias("len"), "term")
    found = hits.groupBy(key).agg(
        F.max(F.when(F.col("kind") == "city", at)).alias("city"),
        F.max(F.when(F.col("kind") == "country", at)).alias("country"),
    )
    return found.filter("city IS NOT NULL AND country IS NOT NULL").select(
        key, F.col("city.term").alias("city"), F.col("country.term").alias("country")
    )
