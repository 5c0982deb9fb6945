"""Token ids, counts, packing and the keyed index against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from paperweave.llm import packing, token_counts, token_index, tokens

SIGNS = "ab C'sé  \n\t.,12½ǅßİΣσς中文́  👍🏽\x1c\x85\xa0'll don't<|endoftext|><|startoftext|>\0\r"
DOCS = "doc_id long, text string, start string, n string"
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _texts(n, seed=3, signs=SIGNS):
    draw = random.Random(seed)
    odd = ["".join(draw.choices(signs, k=draw.randrange(16))) for _ in range(n)]
    plain = [" ".join("".join(draw.choices("aeinrst", k=draw.randint(1, 9))) for _ in range(draw.randrange(30))) for _ in range(n // 4)]
    return [*odd, *plain, "", " ", "\n", "a\n\nb", "a \nb", "a  b ", " a", "it's they'LL", "x<|endoftext|>y", "\n" * 9 + "z"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_library(path, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    known, library = tokens.Encoder(path), Tokenizer.from_file(path)
    for text in _texts(4000):
        ids = np.frombuffer(known.encode(text), known.dtype).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(known.bare) <= 50 and len(known.bare.before) <= 50


def test_counts_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 50)
    own, library = token_counts.PieceCounter(PIECES), SentencePieceProcessor(model_file=PIECES)
    assert own.cuts
    for text in _texts(4000, signs=SIGNS + "▁<s></s>"):
        assert own.count(text) == len(library.encode(text)), repr(text)


def test_token_counts(spark):
    rows = [(i, t, "clash", "") for i, t in enumerate(_texts(200))] + [(None, None, "", ""), (3, "again", "", "")]
    found = token_counts.token_counts(spark.createDataFrame(rows, DOCS).repartition(3), PIECES, most=20)
    library = SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(spark.createDataFrame([], DOCS), PIECES).collect() == []


def test_counts_of_unbroken_texts(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=150_000)), "a b a", "x" * 300 + " b"]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    library = SentencePieceProcessor(model_file=PIECES)
    want = [(i, len(t), len(library.encode(t))) for i, t in enumerate(texts)]
    assert want[0][2] > 65_535
    assert sorted(map(tuple, token_counts.token_counts(docs, PIECES).collect())) == want


def _check_plan(lengths, capacity, **options):
    lengths = np.array(lengths, np.int64)
    sequence, offset = packing.plan(lengths, capacity, **options)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], lengths[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all()
    assert not len(n) or (o + n).max() <= capacity
    return len(set(sequence.tolist()))


def test_plans_waste_little():
    draw = random.Random(1)
    assert _check_plan([], 2048) == 0 and _check_plan([2048], 2048) == 1 and _check_plan([1] * 2049, 2048) == 2
    for shape in (lambda: draw.randint(1, 2048), lambda: min(2048, int(draw.expovariate(1 / 400)) + 1)):
        lengths = [shape() for _ in range(4000)]
        bound = -(-sum(lengths) // 2048)
        assert _check_plan(lengths, 2048) <= bound * 1.01 + 1
    assert _check_plan([draw.randint(1, 20) for _ in range(300)], 20, classes=5, parts=3) > 0


def test_least_squares_is_optimal():
    draw = np.random.default_rng(4)
    for _ in range(20):
        a, b = draw.random((8, 15)), draw.random(8) * 5 - 1
        x = packing.nnls(a, b)
        pull = a.T @ (b - a @ x)
        assert (x >= 0).all() and (pull <= 1e-4).all() and np.abs(pull[x > 0]).max(initial=0) < 1e-6


def test_patterns_fill_a_sequence():
    found = packing.patterns(12, 3)
    assert len(found) == len(set(found)) == 18 and all(sum(p) == 12 and 2 <= len(p) <= 3 for p in found)


def test_packed_pieces_hold_all_ids(spark):
    rows = [(i, t * (i % 7), "clash", "") for i, t in enumerate(_texts(120))] + [(None, None, "", ""), (3, "again", "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    pieces = packing.token_pieces(docs, WORDS, end_id=0, capacity=16).withColumn("offset", F.lit("clash"))
    found = packing.pack(pieces, capacity=16, shard_pieces=50).collect()
    library, want = Tokenizer.from_file(WORDS), []
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, s, ids[s : s + 16]) for k, s in enumerate(range(0, len(ids), 16))]
    assert sorted(((r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in found), key=str) == sorted(want, key=str)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in places.values():
        at.sort()
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 16
    assert packing.pack(pieces.limit(0)).collect() == []


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000):
        high, low = token_index._hashes(range(n), [0] * n)
        sizes, bitmap, slots = token_index.build(high, low)
        assert sorted(slots.tolist()) == list(range(n))
        if n:
            assert (token_index.find(sizes, bitmap, high, low) == slots).all()


def test_index_finds_every_document_and_no_other(spark):
    rows = [(7 * i, t, "clash", "") for i, t in enumerate(_texts(300))] + [(None, "no id", "", ""), (14, None, "", ""), (14, "again", "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    written = token_index.with_starts(token_index.write_shards(docs, BYTES, 2, folder := token_index.scratch_path(spark, "t")))
    index = token_index.build_index(written, bucket_keys=40)
    assert index.count() > 3
    found = token_index.read_ids(token_index.lookup(token_index.document_keys(docs), index), folder).collect()
    library, want, start = Tokenizer.from_file(BYTES), [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(((r.id, r.start, r.n, zlib.crc32(r.ids)) for r in found), key=str) == sorted(want, key=str)
    strangers = spark.range(500).select((F.col("id") * 7 + 3).alias("id"), F.lit(0).alias("turn"))
    assert token_index.lookup(strangers, index).count() == 0


def test_index_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    index, folder = token_index.token_index(docs, BYTES, 2)
    assert token_index.read_ids(token_index.lookup(token_index.document_keys(docs), index), folder).collect() == []


def test_packing_keeps_few_words(spark, monkeypatch):
    """A worker that packs holds a bounded cache beside what the stages before it have left."""
    import corpus_pipeline

    kept = {}
    monkeypatch.setattr(tokens, "ENCODERS", {})
    monkeypatch.setattr(packing, "map_rows", lambda df, handle, schema: kept.setdefault("handle", handle) and df)
    monkeypatch.setattr(packing, "pack", lambda pieces: pieces)
    corpus_pipeline.pack_sequences(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "")
    ids = [np.frombuffer(row[4], "<u4").tolist() for row in kept["handle"]([(1, b"a b"), (2, None)])]
    (known,) = tokens.ENCODERS.values()
    assert ids == [[*np.frombuffer(known.encode("a b"), known.dtype).tolist(), 0], [0]]
    assert known.bare.limit <= 150_000
    small = tokens.Encoder(WORDS, cache=10)
    for n in range(100):
        assert small.encode(f"w{n} x{n}") == known.encode(f"w{n} x{n}")
        assert len(small.bare) <= 11 and len(small.bare.before) <= 11
