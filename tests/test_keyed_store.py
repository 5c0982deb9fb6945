"""Tables that later loads merge into, and ids that stay."""

import random

import pytest
from pyspark.sql import functions as F

from paperweave.operators.id_dictionary import IdDictionary
from paperweave.operators.propgraph import merge_nodes, node, node_rows
from paperweave.sources.keyed_store import KeyedStore


def _largest(rows):
    return rows.groupBy("k").agg(F.max("v").alias("v"))


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("part-*")}


def test_loads_merge_and_leave_other_buckets_alone(spark, tmp_path):
    draw = random.Random(3)
    store = KeyedStore(spark, str(tmp_path), ["k"], _largest, buckets=6, most_versions=2)
    assert store.read() is None and store.manifest() == (0, {})
    want, before = {}, {}
    for turn in range(6):
        rows = [(draw.choice([*range(40), None]), draw.randrange(100)) for _ in range(3 if turn else 60)]
        for k, v in rows:
            want[k] = max(want.get(k, -1), v)
        touched = store.load(spark.createDataFrame(rows, "k int, v int"))
        found = store.read()
        assert {r["k"]: r["v"] for r in found.collect()} == want and found.count() == len(want)
        after = _files(tmp_path / "rows")
        assert all(after[f] == t for f, t in before.items())  # no file is written again
        new = {f.split("_bucket=")[1].split("/")[0] for f in after.keys() - before.keys()}
        assert new == set(map(str, touched))
        assert all(len(v) <= 3 for v in store.manifest()[1].values())
        before = after


def test_readers_keep_what_they_opened(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], _largest, buckets=2, most_versions=1)
    store.load(spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"))
    opened = store.read()
    store.load(spark.createDataFrame([(1, 5), (3, 3)], "k int, v int"))
    assert sorted(map(tuple, opened.collect())) == [(1, 1), (2, 2)]
    assert sorted(map(tuple, store.read().collect())) == [(1, 5), (2, 2), (3, 3)]
    assert store.load(spark.createDataFrame([], "k int, v int")) == []
    assert store.read().count() == 3
    with pytest.raises(ValueError, match="2 buckets"):
        KeyedStore(spark, str(tmp_path), ["k"], _largest, buckets=3).manifest()


def test_a_load_that_broke_off_is_not_seen(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], _largest, buckets=2)
    store.load(spark.createDataFrame([(1, 1)], "k int, v int"))
    store._write(spark.createDataFrame([(1, 99), (8, 8)], "k int, v int"), f"{store.path}/rows/_version=2")
    assert store.read().collect() == [(1, 1)]
    store.load(spark.createDataFrame([(2, 2)], "k int, v int"))
    assert sorted(map(tuple, store.read().collect())) == [(1, 1), (2, 2)]


def test_two_node_loads_equal_one(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i % 7}", f"t{i % 7}" if i % 2 else None) for i in range(30)], "key string, title string")
    nodes = node_rows(rows, node("Paper", {"key": F.col("key")}, title=F.col("title")))
    store = KeyedStore(spark, str(tmp_path), ["label", "id"], merge_nodes, buckets=4)
    for half in (0, 1):
        store.load(nodes.filter(F.pmod(F.xxhash64("id", "title"), F.lit(2)) == half))
    assert sorted(map(str, store.read().collect())) == sorted(map(str, merge_nodes(nodes).collect()))


def test_ids_stay(spark, tmp_path):
    ids = IdDictionary(spark, str(tmp_path), start=10, buckets=3)

    def load(values, **options):
        found = ids.extend(spark.createDataFrame([(v,) for v in values], "name string"), "name", **options)
        return {r["value"]: r["node_id"] for r in found.collect()}

    assert load([None]) == {} and ids.next_id() == 10
    first = load(["b", "a", "b", None, ""])
    assert first == {"": 10, "a": 11, "b": 12}
    second = load(["c", "a", "aa"])
    assert second == first | {"aa": 13, "c": 14}
    assert load(["b"]) == second
    assert load(["d"], start=50) == second | {"d": 50}
    assert load(["e"], start=20)["e"] == 51  # ids between are left, none is given twice
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, "d")], "rec long, value string")
    assert sorted(map(tuple, ids.edges(pairs, "rec").collect())) == [(1, 11), (2, 50)]
