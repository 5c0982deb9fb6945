"""The operators over their whole tables, by query key, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import centroids, decontam, divergence, lang_id, packing, piece_codec, quality, token_counts, token_index, url_filter, warc
from .common import ASCII_UPPER, draw
from .exact_dedup import exact_duplicates
from .near_dup import near_duplicates

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _held_out(parts: int, fold: int):
    """Whether a document is in the fold that isn't learned from; one without id isn't learned from either."""
    return F.coalesce(draw(F.col("doc_id"), parts) == fold, F.lit(True))


def near_dup(spark, sf):
    return near_duplicates(table(spark, sf, "documents"), shingle_words=2, percent=80)


def warc_archive(spark, sf):
    pages = table(spark, sf, "pages")
    folder = scratch_path(spark, "warc")
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    warc.write_archive(warc.revisits(pages, "page_id", payload), folder)
    return warc.payloads(warc.read_chunks(spark, folder)).withColumnRenamed("key", "page_id")


def exact_dedup(spark, sf):
    return exact_duplicates(table(spark, sf, "documents"))


def quality_classifier(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    known = labels.filter(draw(F.col("doc_id"), 5) != 0).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return quality.score(docs, quality.train(docs, known)).select(
        "doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def language_id(spark, sf):
    docs = table(spark, sf, "documents")
    models = lang_id.train(docs.filter(draw(F.col("doc_id"), 3) != 1))
    return lang_id.predict(docs, models).withColumn("held_out", _held_out(3, 1))


def token_ids(spark, sf):
    docs = table(spark, sf, "documents")
    index, folder = token_index.token_index(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    found = token_index.lookup(token_index.document_keys(docs), index)
    return token_index.read_ids(found, folder).select(
        F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def decontamination(spark, sf):
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), least=1)


def packed(spark, sf):
    pieces = packing.token_pieces(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests).withColumn("length", F.col("length").cast("long"))


def url_filters(spark, sf):
    return url_filter.filter_urls(table(spark, sf, "pages"), URL_RULES)


def counted_tokens(spark, sf):
    counts = token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def clustered(spark, sf):
    return centroids.with_inertia(*centroids.cluster_vectors(table(spark, sf, "embeddings"), clusters=16, rounds=3))


def piece_round_trip(spark, sf):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_codec.encode(table(spark, sf, "documents"), path, end_id=2)
    return piece_codec.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def source_divergence(spark, sf):
    return divergence.divergences(table(spark, sf, "documents"), least_docs=3, top_terms=200)


LOWER = f"translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"

NEAR_DUP_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
n AS (SELECT doc_id, len(s) AS n FROM sets),
e AS (SELECT doc_id, unnest(s) AS g FROM sets),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT n.doc_id, n.n AS n_shingles, min(b) AS component_id, min(b) = n.doc_id AS kept
FROM n JOIN reach ON a = n.doc_id GROUP BY n.doc_id, n.n
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS f FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f <> page_id THEN f END AS refers_to FROM f
"""

EXACT_SQL = f"""
WITH t AS (SELECT doc_id, {LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM t JOIN g USING (t)
"""

def _centroid_sql(rounds: int, clusters: int) -> str:
    nearest = """a{r} AS MATERIALIZED (SELECT k, vec_id, v, m.d AS distance, m.c AS cluster FROM (
  SELECT k, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS m FROM (
    SELECT k, vec_id, x.v, c, list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - y.v[i]) * (x.v[i] - y.v[i])))::BIGINT AS d
    FROM x, c{r} y) GROUP BY k))"""
    moved = """s{r} AS (SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY ALL),
m{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY cluster),
c{n} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} m ON m.cluster = c)"""
    turns = ",\n".join(f"{nearest.format(r=r)},\n{moved.format(r=r, n=r + 1)}" for r in range(rounds))
    return f"""
WITH fit AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
x AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS v FROM fit),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM x ORDER BY c LIMIT {clusters}),
{turns},
{nearest.format(r=rounds)}
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(y.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} y ON y.c = cluster
"""


DIVERGENCE_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
n AS (SELECT k, lang, source, term, count(*) AS n FROM t GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n)::BIGINT AS total FROM n GROUP BY ALL HAVING count(*) >= 3),
l AS (SELECT lang, count(*) AS size, sum(total)::BIGINT AS whole FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, sum(n)::BIGINT AS n FROM n SEMI JOIN kept USING (lang, term) GROUP BY ALL),
o AS (SELECT lang, source, sum(n)::BIGINT AS own FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, term, coalesce(n, 0) AS n,
    1 + 1000000000 * (coalesce(n, 0) + 1) // (coalesce(own, 0) + size) AS p, 1 + 1000000000 * (total + 1) // (whole + size) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN o USING (lang, source) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a
  JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM part QUALIFY part = 'pair' OR rank <= 200
"""

QUERIES = {
    "op1_minhash_near_dedup": near_dup,
    "op2_warc": warc_archive,
    "op3_exact_dedup": exact_dedup,
    "op4_quality_classifier": quality_classifier,
    "op5_language_id": language_id,
    "op6_token_ids": token_ids,
    "op7_decontamination": decontamination,
    "op8_best_fit_packing": packed,
    "op9_url_filters": url_filters,
    "op10_token_counts": counted_tokens,
    "op11_centroid_clustering": clustered,
    "op12_piece_codec": piece_round_trip,
    "op13_source_divergence": source_divergence,
}
ORACLES = {
    "op1_minhash_near_dedup": NEAR_DUP_SQL,
    "op2_warc": WARC_SQL,
    "op3_exact_dedup": EXACT_SQL,
    "op11_centroid_clustering": _centroid_sql(rounds=3, clusters=16),
    "op13_source_divergence": DIVERGENCE_SQL,
}
