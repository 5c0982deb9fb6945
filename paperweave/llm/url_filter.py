"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule decides teach a model of accepted and one of rejected URLs: variable-order Markov models over
bytes, orders blended by Witten and Bell's rule. Other URLs are judged by the difference of
the two log-likelihoods for each byte against a threshold calibrated on rule-decided URLs
that the models have not seen.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, draw, map_rows
from .markov import Models, frozen, gram_counts, text_bits

ORDER = 4
STEP, REACH = 0.01, 800  # calibration histogram: differences of -8 to 8 bits for a byte


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^([^?#]*)", 1)
    return ascii_lower(host), path


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest ``(verdict, host, path)`` that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, own, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        name = F.when(fits, F.lit(own + start)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def _differences(urls: DataFrame, models: Models, schema: str) -> DataFrame:
    """The columns named by ``schema``, and the bits for a byte by which ``allow`` predicts ``url`` better than ``block``."""
    order, bits_of = models.order, models.scorer("blended_bits")
    allow, block = models.names.index("allow"), models.names.index("block")

    def scored(rows):
        keyed = ((row, url or b"") for *row, url in rows)
        for row, bits, size in text_bits(keyed, order, bits_of):
            yield *row, float((bits[block] - bits[allow]) / size) if size else 0.0

    columns = [field.split()[0] for field in schema.split(", ")]
    return map_rows(urls.select(*columns, F.col("url").cast("binary")), scored, f"{schema}, difference double")


def threshold(models: Models, urls: DataFrame) -> float:
    """The difference that separates ``urls(kind, url)`` best: half-sum of both classes' hit rates, nearest to 0."""
    place = F.least(F.greatest(F.floor(F.col("difference") / STEP), F.lit(-REACH)), F.lit(REACH)).cast("int")
    rows = _differences(urls, models, "kind string").groupBy("kind", place.alias("place")).count().collect()  # at most 2 * 1601 rows
    counts = {k: np.zeros(2 * REACH + 1) for k in ("allow", "block")}
    for kind, at, n in rows:
        counts[kind][at + REACH] = n
    if not counts["allow"].sum() or not counts["block"].sum():
        return 0.0
    above = np.concatenate([np.cumsum(counts["allow"][::-1])[::-1], [0]]) / counts["allow"].sum()
    below = np.concatenate([[0], np.cumsum(counts["block"])]) / counts["block"].sum()
    best = np.flatnonzero(above + below >= (above + below).max() - 1e-12)
    return float((best[np.argmin(np.abs(best - REACH))] - REACH) * STEP)


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
    max_grams: int | None = None,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, difference)`` for each row of ``pages``.

    ``rules`` is a short list that becomes part of the query. Every rule-decided URL is counted, but for the fifth
    (crc32 of the URL) that calibrates; where one verdict has no URL outside that fifth, all teach and the
    threshold is 0. Where no rule accepts anything, all other URLs are blocked, where none rejects anything,
    allowed. A null URL has empty parts and difference 0. ``max_grams`` bounds the models, each having its share.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"))
    parts = parts.withColumn("host", host).withColumn("path", path)
    name, decided = longest_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumn("rule", name).withColumn("kind", decided)
    known = judged.filter("kind is not null")
    tuning = draw(F.col("url"), 5) == 0
    decided = known.groupBy("kind").agg(F.count_if(~tuning).alias("teaching")).collect()  # at most 2 rows
    columns = [F.col("id").alias(id_col), "host", "path", "rule"]
    if len(decided) < 2:
        other = F.lit("block" if [r["kind"] for r in decided] == ["block"] else "allow")
        return judged.select(*columns, F.coalesce("kind", other).alias("verdict"), F.lit(0.0).alias("difference"))
    apart = all(r["teaching"] for r in decided)
    teaching = known.filter(~tuning) if apart else known
    models = frozen(gram_counts(teaching.select(F.col("kind").alias("class"), F.col("url").alias("text")), order), order, max_grams)
    cut = threshold(models, known.filter(tuning)) if apart else 0.0
    scored = _differences(judged, models, "id long, host string, path string, rule string, kind string")
    method = F.when(F.col("difference") >= cut, "allow").otherwise("block")
    return scored.select(*columns, F.coalesce("kind", method).alias("verdict"), "difference")
