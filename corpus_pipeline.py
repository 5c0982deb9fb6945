"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperweave.llm import decontam, packing, quality
from paperweave.llm.common import draw, stored, without
from paperweave.llm.exact_dedup import exact_duplicates
from paperweave.llm.near_dup import near_duplicates

WORDS = 150_000  # a generation of a packing worker's cache: the default took some 300 MB beside all that earlier stages leave


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; labels of the held-out fold aren't learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.filter(draw(F.col("doc_id"), 5) != 0).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return quality.keep(docs, quality.train(docs, known), least=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return without(docs, exact_duplicates(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8), the document with the smallest id."""
    return without(docs, near_duplicates(docs, shingle_words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=1)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, piece, start, length, ids, sequence_id, offset)``: token pieces and their place in sequences of 2048."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, words=WORDS))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None  # a learned score and token ids are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
