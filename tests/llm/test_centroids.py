"""Centroid clustering against plain k-means in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from paperweave.llm import centroids

ROWS = "vec_id long, embedding array<float>, row string, vector string, cells string, length string, cluster string, distance string"
ODD = [[1.0, 2.0, 3.0, None], [1.0, 2.0, float("nan"), 4.0], [1.0, float("inf"), 0.0, 0.0], [1.0, 2.0, 3.0], [], None, [0.0] * 5]


def _vectors(n, seed, spread=1.0):
    draw = random.Random(seed)
    middles = [[draw.uniform(-2, 2) for _ in range(4)] for _ in range(5)]
    return [[float(np.float32(m + draw.gauss(0, spread))) for m in draw.choice(middles)] for _ in range(n)]


def _naive(rows, k, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    found = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(found))

    for _ in range(rounds):
        own = [[] for _ in found]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        found = [[sum(x) // len(o) for x in zip(*o)] if o else c for o, c in zip(own, found)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), found


@pytest.mark.parametrize("bits, spread, k", [(4, 1.0, 6), (1, 0.2, 6), (8, 3.0, 16), (6, 0.0, 6)])
def test_equals_plain_means(spark, bits, spread, k):
    rows = [(i // 2 if i % 7 == 0 else i, v) for i, v in enumerate(_vectors(300, 3, spread))]
    rows += [(1000 + i, v) for i, v in enumerate(ODD)] + [(None, rows[0][1]), (None, rows[1][1]), rows[5], rows[5]]
    df = spark.createDataFrame([(*r, "", "", "", "", "", "") for r in rows], ROWS).repartition(5)
    found, middle = centroids.cluster_vectors(df, clusters=k, rounds=3, width=4, scale=64, bits=bits, sample=100)
    want, at = _naive(rows, k, 3, 64)
    assert sorted(map(tuple, found.collect()), key=str) == want and middle.tolist() == at


def test_few_or_no_vectors(spark):
    for rows in ([], [(1, None)], [(4, [0.5, 1.0, 1.0, -1.0])], [(2, [1.0] * 4), (2, [1.0] * 4), (3, [-1.0] * 4)]):
        df = spark.createDataFrame([(*r, "", "", "", "", "", "") for r in rows], ROWS)
        found = centroids.with_inertia(*centroids.cluster_vectors(df, clusters=5, rounds=2, width=4))
        want, at = _naive(rows, 5, 2, 64)
        assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()) == want
        for r in found.collect():
            assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, at[r["cluster"]])).encode()).hexdigest()
            assert r["inertia"] == sum(d for *_, d in want)
            assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])


def test_huge_components(spark):
    df = spark.createDataFrame([(1, [3e38, -3e38, 0.0, 1.0]), (2, [0.0] * 4)], "vec_id long, embedding array<float>")
    found, middle = centroids.cluster_vectors(df, clusters=2, rounds=1, width=4)
    assert sorted(map(tuple, middle.tolist())) == [(0, 0, 0, 0), (1 << 24, -(1 << 24), 0, 64)]
    assert {r["distance"] for r in found.collect()} == {0}


def test_intervals_hold_and_settle_most():
    draw = np.random.default_rng(1)
    middle = draw.integers(-20, 20, (6, 32))
    vectors = np.floor(draw.normal(middle[draw.integers(0, 6, 2000)], 4)).astype(np.int64)
    inner = np.quantile(vectors, np.arange(1, 16) / 16, axis=0, method="nearest").T
    edges = np.concatenate([vectors.min(axis=0)[:, None], inner, vectors.max(axis=0)[:, None]], axis=1)
    cells = np.stack([np.searchsorted(inner[d], vectors[:, d], "right") for d in range(32)], axis=1).astype(np.uint8)
    candidates = centroids.Bounds(edges, middle).open(cells, (vectors**2).sum(axis=1))
    exact = ((vectors[:, None] - middle) ** 2).sum(axis=2)
    assert candidates[np.arange(2000), exact.argmin(axis=1)].all()
    assert (candidates.sum(axis=1) == 1).mean() > 0.9
    packed = centroids._packed(cells, 4)
    assert {len(p) for p in packed} == {16}
    batch = pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["cells"])
    assert (centroids._cells(batch, edges) == cells).all()
