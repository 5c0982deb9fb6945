"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader.

Features of a text are its words, pairs of words, word shapes (runs of letters as ``a`` or ``A``,
of digits as ``0``, other signs as they are) and pairs of shapes, which also tell whether the two words
are the same, hashed to ``2**BITS`` places.
A place has the value count / sqrt(number of features), so a score is a sparse dot product.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, map_rows, mixed, ship, sliced

BITS = 18
LOW = (1 << 24) - 1
SCALE = 1e9  # weights are summed as whole numbers, so their order doesn't matter
SLICE = 1 << 17


class Shapes(dict):
    """Word to 64 bits: 40 of the word's hash above 24 of its shape's."""

    run = re.compile(r"[^\W\d_]+|\d+")

    def __missing__(self, word: str) -> int:
        shape = self.run.sub(lambda m: "0" if m[0][0].isdigit() else "A" if len(m[0]) > 1 and m[0].isupper() else "a", word)
        value = (xxhash.xxh3_64_intdigest(word) & ~LOW) | (xxhash.xxh3_64_intdigest(shape) & LOW)
        self[word] = value
        return value


def _places(values: np.ndarray) -> np.ndarray:
    return (mixed(values) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: bytes | None, cache: Shapes) -> list[np.ndarray]:
    """Hashed places, with repeats, in slices of bounded size; none without words."""
    words = text.decode("utf-8", "replace").split() if text else []
    if len(cache) > 200_000:
        cache.clear()
    out = []
    for start in range(0, len(words), SLICE):
        part = words[max(0, start - 1) : start + SLICE]
        word = np.fromiter(map(cache.__getitem__, part), np.uint64, len(part))
        shape = word & np.uint64(LOW)
        again = (word[:-1] == word[1:]).astype(np.uint64) << np.uint64(50)
        pairs = [word[:-1] * MIX + word[1:] * np.uint64(3) + np.uint64(1), shape[:-1] * MIX + shape[1:] * np.uint64(3) + again]
        skip = 1 if start else 0
        out.append(_places(np.concatenate([word[skip:], shape[skip:] + np.uint64(1 << 40), *pairs])))
    return out


def _ftrl(examples, rate: float, beta: float, l1: float, l2: float, epochs: int) -> np.ndarray:
    """Weights after FTRL-proximal updates, row by row; place ``2**BITS`` is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        pull = z[at]
        return np.where(np.abs(pull) <= l1, 0.0, -(pull - np.sign(pull) * l1) / ((beta + np.sqrt(n[at])) / rate + l2))

    for _ in range(epochs):
        for at, x, label in examples:
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            grown = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / rate * w
            n[at] = grown
    return weights(np.arange(len(z)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = 16_000,
    learner_rows: int = 4_000,
    epochs: int = 3,
    rate: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.01,
    l2: float = 0.1,
) -> np.ndarray:
    """Weights learned from ``labels(id, label)``.

    ``max_rows`` bounds the labelled rows that are used (those with the smallest hash of the id); they are
    dealt to learners of about ``learner_rows`` rows whose weights are averaged. The model has a fixed size.
    Without labelled rows all weights are 0 and every score is 0.5. Null ids and labels are left out.
    """
    ship(docs.sparkSession)
    usable = labels.select(F.col("id").cast("long"), F.col("label").cast("int")).dropna()
    chosen = usable.withColumn("o", F.xxhash64("id")).orderBy("o", "id", "label").limit(max_rows)
    shards = max(1, -(-chosen.count() // learner_rows))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).join(
        F.broadcast(chosen), "id"  # at most max_rows rows
    )
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.col("id") + 1), F.lit(shards)))

    def learn(group):
        import pyarrow as pa

        cache, examples = Shapes(), []
        ids, text, label = (group.column(c).to_pylist() for c in ("id", "text", "label"))
        for k in sorted(range(len(ids)), key=lambda k: (xxhash.xxh3_64_intdigest(str(ids[k])), label[k], text[k] or b"")):
            at, count = np.unique(np.concatenate([*features(text[k], cache), np.zeros(0, np.int64)]), return_counts=True)
            x = np.append(count / max(1.0, np.sqrt(count.sum())), 1.0)
            examples.append((np.append(at, 1 << BITS).astype(np.int32), x.astype(np.float32), label[k]))
        w = np.round(_ftrl(examples, rate, beta, l1, l2, epochs) * SCALE).astype(np.int64)
        at = np.flatnonzero(w)
        at = at if len(at) else np.array([1 << BITS])
        return pa.table({"place": pa.array(at, pa.int64()), "w": pa.array(w[at], pa.int64())})

    learned = rows.groupBy("shard").applyInArrow(learn, "place long, w long")
    weights = np.zeros((1 << BITS) + 1)
    for place, total in learned.groupBy("place").agg(F.sum("w")).collect():  # at most 2**BITS + 1 rows
        weights[place] = total / SCALE / shards
    return weights.astype(np.float32)


def probability(text: bytes | None, weights: np.ndarray, cache: Shapes) -> float:
    total = n = 0
    for places in features(text, cache):
        total, n = total + float(weights[places].sum(dtype=np.float64)), n + len(places)
    return float(1 / (1 + np.exp(-np.clip(total / max(1, n) ** 0.5 + weights[-1], -35, 35))))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row: the probability of label 1; null or wordless texts get the bias's."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scores(rows):
        cache = Shapes()
        for identity, text in rows:
            yield identity, probability(text, shared.value, cache)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_rows(texts, scores, "id long, score double").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, weights: np.ndarray, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose score is at least ``least``; nothing is moved."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def passed(batches):
        import pyarrow as pa

        cache = Shapes()
        for batch in sliced(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([probability(t, shared.value, cache) >= least for t in texts], pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
