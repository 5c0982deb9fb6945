"""Odd inputs that operators must pass through, and the columns of every query."""

import numpy as np
import pytest

from paperweave.llm import decontam, packing, queries, warc
from paperweave.llm.common import without
from paperweave.session import scratch_path

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_minhash_near_dedup": "doc_id n_shingles component_id kept",
    "op2_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op3_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op4_quality_classifier": "doc_id held_out score predicted",
    "op5_language_id": "doc_id held_out lang_pred score",
    "op6_token_ids": "doc_id start n_tokens ids_crc32",
    "op8_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_url_filters": "page_id host path rule verdict",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op12_piece_codec": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_source_divergence": "lang source part item value rank",
}


@pytest.mark.parametrize("name", ["op4_quality_classifier", "op5_language_id", "op11_centroid_clustering", "op12_piece_codec", "op13_source_divergence"])
def test_columns_of_queries(spark, name):
    found = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(found.columns)
    assert found.count() > 0


def test_a_column_named_dropped_stays(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "doc_id long, _dropped string")
    decisions = spark.createDataFrame([(1, True), (2, False), (None, True)], "doc_id long, kept boolean")
    assert sorted(map(tuple, without(docs, decisions).collect()), key=str) == [(1, "a"), (None, "c")]


def test_packing_keeps_a_column_named_row(spark):
    pieces = spark.createDataFrame([(i, 100 + i, f"r{i}") for i in range(40)], "doc_id long, length int, _row string")
    found = packing.pack(pieces, capacity=512).collect()
    assert sorted(r["_row"] for r in found) == sorted(f"r{i}" for i in range(40))


def test_null_payloads(spark):
    pages = spark.createDataFrame([(1, "u", None, None, None), (2, None, bytearray(b"x"), None, None)],
        "key long, url string, payload binary, payload_digest string, refers_to long")
    folder = scratch_path(spark, "warc")
    warc.write_archive(pages, folder)
    found = {r["key"]: r["payload_bytes"] for r in warc.payloads(warc.read_chunks(spark, folder)).collect()}
    assert found == {1: 0, 2: 1}


def test_hits_in_blocks_are_the_same(monkeypatch):
    draw = np.random.default_rng(2)
    items = [(k, " ".join(draw.choice(list("ab"), 40)).encode()) for k in range(5)]
    index, words = decontam.Index(items, 8), decontam.Hashes().of(" ".join(draw.choice(list("ab"), 400)).encode())
    whole = index.diagonals(words)
    monkeypatch.setattr(decontam, "HITS", 7)
    assert sorted(map(tuple, index.diagonals(words))) == sorted(map(tuple, whole)) and len(whole) > 20


def test_documents_of_a_batch_are_hit_as_if_alone():
    draw, cache = np.random.default_rng(11), decontam.Hashes()
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choice(vocabulary, n)).encode()) for i, n in enumerate([8, 9, 13, 30, 60])]
    index = decontam.Index(items, 8)
    texts = [b"", b"w1", *(t for _, t in items)]
    for _, text in items:
        words = text.decode().split()
        half = len(words) // 2
        # A passage cut over two documents is in neither.
        texts += [" ".join(words[:half]).encode(), " ".join(words[half:]).encode()]
        texts.append(" ".join([*draw.choice(vocabulary, 20), *words, *draw.choice(vocabulary, 5)]).encode())
    docs = [cache.of(t) for t in texts]
    alone = {d: found for d, words in enumerate(docs) if (found := index.overlaps(words, 13, 0.8))}
    assert index.batch_overlaps(docs, 13, 0.8) == alone and len(alone) >= 10
    hits = {d: found for d, words in enumerate(docs) if (found := index.diagonals(words))}
    assert index.batch_diagonals(docs) == hits
    assert decontam.Index([], 8).batch_overlaps(docs, 13, 0.8) == {}
