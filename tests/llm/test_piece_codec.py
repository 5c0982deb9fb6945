"""Piece ids and texts against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from paperweave.llm import piece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "ab C'sé  \n\t.,12½ǅßİΣσς中文́  👍🏽\x1c\x85\xa0'll don't▁<s></s>\0\r"
DOCS = "doc_id long, text string, id string, ids string"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def _texts(n, seed):
    draw = random.Random(seed)
    odd = ["".join(draw.choices(SIGNS, k=draw.randrange(30))) for _ in range(n)]
    plain = ["".join(draw.choices("aeinrst", k=draw.randint(1, 60))) for _ in range(n)]
    return [*odd, *plain, "", " ", "\n", "▁", "   a", "<0x0A>", "<unk>", "a" * 999, " " * 999, "=" * 333, "中" * 500]


def test_ids_equal_the_library(library, monkeypatch):
    for name in ("STRETCHES", "PAIRS"):
        monkeypatch.setattr(piece_codec, name, 50)
    own = piece_codec.PieceCodec(PATH)
    for text in _texts(4000, 3):
        ids = np.frombuffer(own.encode(text), "<i4")
        assert ids.tolist() == library.encode(text), repr(text)
        assert own.decode(ids) == library.decode(ids.tolist()), repr(text)
    assert len(own.known) <= 50 and len(own.beside) <= 50


def test_pieces_beside_their_merges(library):
    """Texts made of pieces themselves: those that can't stand side by side make the encoder go back."""
    own, draw = piece_codec.codec(PATH), random.Random(8)
    pieces = [p for p in own.ids if "▁" not in p]
    for _ in range(4000):
        text = "".join(draw.choices(pieces, k=draw.randint(2, 6)))
        assert np.frombuffer(own._stretch("▁" + text), "<i4").tolist() == library.encode(text), repr(text)


def test_decoding_of_any_ids(library):
    own, draw = piece_codec.codec(PATH), random.Random(4)
    odd = [0, 1, 2, 28705, *(3 + b for b in "中é".encode()), 3 + 0xFF, 3 + 0xE4]
    for _ in range(5000):
        ids = [draw.choice([draw.choice(odd), draw.randrange(32_000)]) for _ in range(draw.randrange(9))]
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_long_stretches(library):
    draw = random.Random(6)
    own = piece_codec.PieceCodec(PATH)
    for signs in ("abcdefghijklmnopqrstuvwxyz0123456789+/", "ab", "的一是不了人我在有"):
        text = "".join(draw.choices(signs, k=100_000))
        assert np.frombuffer(own.encode(text), "<i4").tolist() == library.encode(text)
    assert not len(own.known)  # too long to be remembered


def test_tables(spark, library):
    rows = [(i, t) for i, t in enumerate(_texts(100, 5))] + [(None, "no id"), (None, None), (7, "again"), (7, "again"), (8, None)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS).repartition(3)
    found = piece_codec.decode(piece_codec.encode(docs, PATH, end_id=2), PATH).collect()
    want = [(i, [*library.encode(t or ""), 2], library.decode([*library.encode(t or ""), 2])) for i, t in rows]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert piece_codec.encode(docs.limit(0), PATH).collect() == []
    nothing = spark.createDataFrame([(1, []), (2, None)], "doc_id long, ids array<int>")
    assert sorted(map(tuple, piece_codec.decode(nothing, PATH).collect())) == [(1, [], ""), (2, [], "")]
