"""Near and exact duplicates against brute force."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from paperweave.llm import exact_dedup, near_dup
from paperweave.llm.components import connected_components
from paperweave.llm.exact_dedup import cut, exact_duplicates
from paperweave.llm.near_dup import near_duplicates

DOCS = "doc_id long, text string, n_shingles string, kept string"


def _texts(seed, groups=12, size=12, words=60):
    draw = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{g}_{k}" if draw.random() < 0.7 else f"c{draw.randrange(8)}" for k in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randrange(9)):
                text[draw.randrange(words)] = f"x{draw.randrange(40)}"
            out.append(" ".join(text))
    out += [None, "", " \t", "One", "one", "A b", "a  B", "a b c", out[3].upper(), out[3]]
    draw.shuffle(out)
    return [(i, t, "clash", None) for i, t in enumerate(out)]


def _sets(rows, size):
    found = {}
    for i, text, *_ in rows:
        w = (text or "").lower().split()
        found[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    return found


def _components(rows, size):
    sets = _sets(rows, size)
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            top[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    rows = _texts(size)
    found = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3), shingle_words=size)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == _components(rows, size)


def test_remaining_pairs_alone_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(near_dup, "SLICE_SHINGLES", 500)
    rows = _texts(9, groups=5)
    found = near_duplicates(spark.createDataFrame(rows, DOCS), shingle_words=2, star_rounds=0)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == _components(rows, 2)


def test_bucket_over_many_ranges(spark):
    rows = [(1, m, 5) for m in range(400)] + [(k, k + 1000, 5) for k in range(2, 60)] + [(99, 7, 5), (99, 9, 6)]
    found = near_dup._bucket_members(spark.createDataFrame(rows, "key long, member long, size int")).collect()
    links = {(r.key, r.leader, r.member) for r in found if r.leader != r.member}
    assert {k for k, *_ in links} == {1, 99}
    reach = {0}
    for _ in range(10):
        reach |= {m for k, a, b in links if k == 1 for m in (a, b) if a in reach or b in reach}
    assert reach == set(range(400))
    assert (99, 7, 9) in links


def test_null_ids_and_empty_tables(spark):
    rows = [(None, "a b c d e f", "", ""), (5, "a b c d e f", "", ""), (5, "a b c d e f", "", "")]
    found = sorted(near_duplicates(spark.createDataFrame(rows, DOCS)).collect(), key=str)
    assert [tuple(r) for r in found] == [(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False)]
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    assert exact_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)]
    random.Random(1).shuffle(edges)
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_chunks_rebuild_the_text_and_survive_a_shift():
    draw = random.Random(4)
    data = bytes(draw.randrange(256) for _ in range(60_000))
    chunks = cut(data, 10, 256, 8192)
    assert b"".join(chunks) == data and max(map(len, chunks)) <= 8192
    assert len(set(chunks) & set(cut(b"some words before" + data, 10, 256, 8192))) > len(chunks) * 0.9
    assert cut(b"", 10, 256, 8192) == [] and b"".join(cut(b"\0" * 50_000, 10, 256, 8192)) == b"\0" * 50_000


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(spark, bits):
    draw = random.Random(bits)
    long = ["".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(300, 4000))) for _ in range(12)]
    texts = [None, "", "É", "é", "Abc", "aBC", "abc ", *long, *(t.upper() for t in long[:6]), *(t + "x" for t in long[:4])]
    rows = [(i, t, "clash", None) for i, t in enumerate(texts)] + [(None, "ABC", "", ""), (None, "q", "", ""), (4, "Abc", "", "")]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    found = sorted((tuple(r) for r in exact_duplicates(frame, hash_bits=bits, mask_bits=6, least=32, most=256).collect()), key=str)
    table = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    plain = [(t or "").translate(table) for _, t, *_ in rows]
    want = []
    for (i, *_), p in zip(rows, plain):
        ids = [r[0] for r, q in zip(rows, plain) if q == p]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(p.encode()).hexdigest()))
    assert found == sorted(want, key=str)


def test_collisions_are_told_apart(spark):
    """With hashes of one bit nearly all recipes collide; the result is the same."""
    rows = [(i, f"text {i % 5}", "", "") for i in range(20)]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOCS), hash_bits=1)
    assert {r.doc_id: r.keep_id for r in found.collect()} == {i: 15 + i % 5 for i in range(20)}
    assert found.agg(F.sum("group_size")).first()[0] == 80


def test_the_last_step_of_near_dedup_gives_links_by_the_component(spark):
    from paperweave.llm.near_dup import _rest

    # 30 sets of one component and 20 sets by themselves, all similar; two pairs apart from them.
    near = [(n, list(range(100)) + [1000 + n], 0 if n < 30 else n) for n in range(50)]
    apart = [(n, list(range(n // 2 * 1000, n // 2 * 1000 + 50)), n) for n in range(60, 64)]
    rows = [(1, n, len(s), c) for n, s, c in near + apart]
    members = spark.createDataFrame(rows, "key long, member long, size int, component long")
    sets = spark.createDataFrame([(n, s) for n, s, _ in near + apart], "id long, shingles array<long>")
    links = [tuple(r) for r in _rest(members, sets, 80).collect()]
    assert len(links) <= 22
    group = {n: c for n, _, c in near + apart}
    for a, b in links:
        group = {n: group[a] if g == group[b] else g for n, g in group.items()}
    assert len({group[n] for n in range(50)}) == 1 and group[60] == group[61] and group[62] == group[63]
    assert len(set(group.values())) == 3
