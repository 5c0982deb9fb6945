"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes with frozen counts. A text's code
length under a language is the exact length of its PPM code (method C escapes, with exclusions)
when the counts no longer change; the language with the shortest code is predicted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows
from .markov import Models, frozen, gram_counts, text_bits

ORDER = 3
UNKNOWN = "und"


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER, max_grams: int | None = None) -> Models:
    """A context tree for each non-null language, from the counts of all rows of ``docs``.

    All contexts are kept, block by block where they outgrow one. ``max_grams`` bounds the nodes that are kept
    over all languages, each having its share; rows without language or text teach nothing.
    """
    texts = docs.select(F.col(lang_col).alias("class"), F.col(text_col).alias("text")).dropna()
    return frozen(gram_counts(texts, order), order, max_grams)


def predict(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row: the language and its share of the likelihood.

    Texts that are null or have no letter, and all texts without a model, are ``und`` with score 0. Equal code
    lengths go to the first language by name.
    """
    names = sorted(models)
    order = models.order if models else ORDER
    bits_of = models.scorer("ppm_bits") if models else lambda codes: []

    def scored(rows):
        keyed = (((identity, letters), text if letters else b"") for identity, text, letters in rows)
        for (identity, letters), bits, _ in text_bits(keyed, order, bits_of):
            if not letters or not names:
                yield identity, UNKNOWN, 0.0
                continue
            best = int(bits.argmin())
            yield identity, names[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), letters.alias("letters")
    )
    return map_rows(texts, scored, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
