"""Graph goldens, and brute force on random graphs with and without hot vertices."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from paperweave import driver_queries, views
from paperweave.operators.graph import graph_build, triplets
from paperweave.operators.pagerank import pagerank, pagerank_sweep, top_ranked
from paperweave.operators.pregel import PartitionedEdges, VertexState, graph_max_value, pregel, propagate_max
from paperweave.operators.rank_blocks import RankBlocks
from paperweave.operators.shortest_paths import render_paths, shortest_costs, shortest_costs_by_bucket, shortest_paths
from paperweave.operators.skew import hot_keys
from paperweave.session import planned_shuffles

MAX_VERTICES = [(1, 9), (2, 1), (3, 6), (4, 8)]
MAX_EDGES = [(1, 2), (2, 3), (2, 4), (3, 4), (3, 1)]
PATH_EDGES = [(1, 2, 4), (1, 3, 2), (2, 3, 5), (2, 4, 10), (3, 5, 3), (5, 4, 4), (4, 6, 11)]
PEOPLE = ["a", "b", "c", "d", "e", "f", "g"]
PEOPLE_EDGES = ["ab", "bc", "cb", "fc", "ef", "ed", "da", "ae"]


@pytest.fixture(scope="module")
def random_edges():
    rng = random.Random(7)
    edges = {}
    for _ in range(400):
        edges[rng.randrange(60), rng.randrange(60)] = rng.randrange(0, 9)
    for d in range(1, 60):  # vertex 0 is a hub
        edges[0, d] = rng.randrange(20, 40)
    return [(s, d, w) for (s, d), w in edges.items()]


def frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long, weight long")


def dijkstra(edges, source):
    out = {}
    for s, d, w in edges:
        out.setdefault(s, []).append((d, w))
    best, queue = {source: 0}, [(0, source)]
    while queue:
        cost, v = heapq.heappop(queue)
        if cost > best[v]:
            continue
        for d, w in out.get(v, []):
            if cost + w < best.get(d, float("inf")):
                best[d] = cost + w
                heapq.heappush(queue, (cost + w, d))
    return best


def test_max_golden(spark, rows):
    v = spark.createDataFrame(MAX_VERTICES, "id long, value long")
    e = spark.createDataFrame(MAX_EDGES, "src long, dst long")
    assert rows(propagate_max(v, e)) == [(1, 9), (2, 9), (3, 9), (4, 9)]
    assert rows(graph_max_value(v)) == [(9,)]


def test_max_iter_stops_early(spark, rows):
    v = spark.createDataFrame([(i, i == 0 and 5 or 0) for i in range(4)], "id long, value long")
    e = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "src long, dst long")
    assert rows(propagate_max(v, e, max_iter=2)) == [(0, 5), (1, 5), (2, 5), (3, 0)]


def test_path_golden(spark, rows):
    labels = spark.createDataFrame([(i + 1, c) for i, c in enumerate("ABCDEF")], "id long, label string")
    found = render_paths(shortest_paths(frame(spark, PATH_EDGES), 1), labels)
    assert rows(found) == [
        (1, 0, "A"), (2, 4, "A,B"), (3, 2, "A,C"), (4, 9, "A,C,E,D"), (5, 5, "A,C,E"), (6, 20, "A,C,E,D,F"),
    ]
    assert rows(shortest_costs(frame(spark, PATH_EDGES), 1)) == [(1, 0), (2, 4), (3, 2), (4, 9), (5, 5), (6, 20)]


def test_unreached_is_null_and_negative_weights_need_a_bound(spark):
    e = frame(spark, [(1, 2, 1), (3, 4, 1)])
    found = {r["id"]: (r["dist"], r["path"]) for r in shortest_paths(e, 1).collect()}
    assert found[3] == (None, None) and found[4] == (None, None)
    assert found[2] == (1, [1, 2])
    with pytest.raises(ValueError):
        shortest_costs(frame(spark, [(1, 2, -1)]), 1)
    assert shortest_costs(frame(spark, [(1, 2, -1), (2, 1, 0)]), 1, max_iter=1).count() == 2


def test_paths_against_dijkstra(spark, random_edges):
    best = dijkstra(random_edges, 5)
    weight = {(s, d): w for s, d, w in random_edges}
    found = shortest_paths(frame(spark, random_edges), 5).collect()
    for r in found:
        assert r["dist"] == best.get(r["id"])
        if r["path"]:
            assert r["path"][0] == 5 and r["path"][-1] == r["id"]
            assert sum(weight[a, b] for a, b in zip(r["path"], r["path"][1:])) == r["dist"]


def test_hot_source_is_split_and_results_stay_whole(spark, random_edges):
    # Dearer parallel edges give vertex 0 well over a quarter of all edges.
    extra = [(0, d, w + k) for s, d, w in random_edges if s == 0 for k in (1, 2, 3)]
    laid_out = PartitionedEdges(
        frame(spark, random_edges + extra).withColumnRenamed("weight", "w"), min_hot_rows=10
    )
    assert laid_out.fan_out is not None
    assert laid_out.edges.filter("src = 0").select("slice").distinct().count() > 1
    best = dijkstra(random_edges, 0)
    ids = laid_out.edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    is_source = F.col("id") == 0
    found = pregel(
        ids.withColumn("dist", F.when(is_source, F.lit(0)).cast("long")),
        laid_out,
        start=is_source,
        message=F.col("src.dist") + F.col("edge.w"),
        merge=F.min,
        accept=F.col("state.dist").isNull() | (F.col("msg") < F.col("state.dist")),
        update={"dist": F.col("msg")},
    )
    assert {r["id"]: r["dist"] for r in found.collect() if r["dist"] is not None} == best


def brute_pagerank(vertices, edges, reset, rounds):
    degree = {v: sum(s == v for s, _ in edges) for v in vertices}
    rank = dict.fromkeys(vertices, 1.0)
    for _ in range(rounds):
        incoming = dict.fromkeys(vertices, 0.0)
        for s, d in edges:
            incoming[d] += rank[s] / degree[s]
        rank = {v: reset + (1 - reset) * incoming[v] for v in vertices}
    scale = len(vertices) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


def test_pagerank_people_graph(spark):
    v = spark.createDataFrame([(p,) for p in PEOPLE], "id string")
    e = spark.createDataFrame([(x[0], x[1]) for x in PEOPLE_EDGES], "src string, dst string")
    expected = brute_pagerank(PEOPLE, [(x[0], x[1]) for x in PEOPLE_EDGES], 0.7, 20)
    found = {r["id"]: r["pagerank"] for r in pagerank(e, 0.7, 20, v).collect()}
    assert found == pytest.approx(expected) and sum(found.values()) == pytest.approx(7)
    top = [r["id"] for r in top_ranked(pagerank(e, 0.7, 20, v), 2).collect()]
    assert top == sorted(expected, key=lambda x: -expected[x])[:2]


def test_pagerank_sweep_counts_parallel_edges(spark):
    edges = [(1, 2), (1, 2), (1, 3), (3, 1)]
    e = spark.createDataFrame(edges, "src long, dst long")
    grid = pagerank_sweep(e, [0.7, 0.15], [1, 3]).collect()
    for reset in (0.7, 0.15):
        for rounds in (1, 3):
            found = {r["id"]: r["pagerank"] for r in grid if (r["reset_prob"], r["max_iter"]) == (reset, rounds)}
            assert found == pytest.approx(brute_pagerank([1, 2, 3], edges, reset, rounds))


@pytest.fixture(scope="module")
def trade(spark, tmp_path_factory):
    """A folder of trade tables; two lines of an order name the same part and supplier."""
    folder = str(tmp_path_factory.mktemp("trade"))
    tables = {
        "orders": ("o_custkey long, o_orderkey long", [(c, 10 * c + k) for c in range(4) for k in range(3)] + [(None, 77)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double",
                     [(10 * c + k, (c + n) % 5, (c * k + n) % 3, n, 2.0) for c in range(4) for k in range(3) for n in (1, 2, 6)] + [(0, None, 1, 7, 1.0)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(0, 0), (1, 1), (2, 0)]),
        "customer": ("c_custkey long, c_nationkey int", [(c, c % 2) for c in range(5)]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_pagerank_sweep_query_does_all_rounds(spark, trade):
    edges = [(r["src"], r["dst"]) for r in views.trade_edges(spark, trade).dropna(subset=["src", "dst"]).collect()]
    vertices = sorted({x for e in edges for x in e})
    grid = driver_queries.pagerank_grid(spark, trade).collect()
    assert {(r["reset_prob"], r["max_iter"]) for r in grid} == {(p, n) for p in (0.7, 0.15) for n in (2, 4, 20)}
    for reset in (0.7, 0.15):
        found = {r["id"]: r["pagerank"] for r in grid if (r["reset_prob"], r["max_iter"]) == (reset, 20)}
        assert found == pytest.approx(brute_pagerank(vertices, edges, reset, 20), abs=1e-6)


def test_rank_messages_hold_a_number_for_a_block_and_destination(spark, random_edges):
    edges = [(f"v{s}", f"v{d}") for s, d, _ in random_edges] + [("v0", "v0"), ("v1", "v0"), ("v1", "v0")]
    e = spark.createDataFrame([*edges, (None, "v1"), ("v1", None)], "src string, dst string")
    vertices = sorted({x for edge in edges for x in edge})
    expected = brute_pagerank(vertices, edges, 0.4, 3)
    for min_hot_rows in (200_000, 10):  # with 10, v0 sends from several blocks and gets its sums in each
        laid_out = RankBlocks(e, block_edges=20, min_hot_rows=min_hot_rows)
        places = laid_out.names.selectExpr("place", "explode(ids) AS id").filter("id = 'v0'").count()
        assert places == 1 if min_hot_rows > 10 else places > 1
        arrived, size = None, []
        for _ in range(3):
            arrived = laid_out.send(arrived, [0.4])
            size.append(arrived.agg(F.sum(F.length("a"))).first()[0])
        assert size == size[:1] * 3 and size[0] < 8 * len(set(edges)) + 8 * places * laid_out.blocks
        found = {r["id"]: r["r"] for r in laid_out.named(laid_out.ranks(arrived, [0.4]), ["r"]).collect()}
        scale = len(vertices) / sum(found.values())
        assert {v: r * scale for v, r in found.items()} == pytest.approx(expected)
        laid_out.release()


def test_rank_blocks_collapse_parallel_edges_and_send_ranges(spark, random_edges):
    edges = [(f"v{s}", f"v{d}") for s, d, _ in random_edges] * 2 + [("v1", "v0")] * 90
    e = spark.createDataFrame(edges, "src string, dst string").repartition(3)
    vertices = sorted({x for edge in edges for x in edge})
    expected = brute_pagerank(vertices, sorted(set(edges)), 0.4, 2)
    for min_hot_rows in (200_000, 10):
        laid_out = RankBlocks(e, block_edges=40, min_hot_rows=min_hot_rows, parallel=False)
        sent = laid_out.static.filter(F.col("kind") == 2)
        # A first and a last number for a block's destinations, whatever their count, and one for each hub among them.
        assert sent.filter(F.length("a") > 8 + 4 * (min_hot_rows == 10) * 12).isEmpty() and sent.count() > 1
        arrived = laid_out.send(laid_out.send(None, [0.4]), [0.4])
        found = {r["id"]: r["r"] for r in laid_out.named(laid_out.ranks(arrived, [0.4]), ["r"]).collect()}
        scale = len(vertices) / sum(found.values())
        assert {v: r * scale for v, r in found.items()} == pytest.approx(expected)
        laid_out.release()
    once = {r["id"]: r["pagerank"] for r in pagerank(e, 0.4, 2, parallel=False).collect()}
    assert once == pytest.approx(expected)


def test_pagerank_query_ranks_numbers(spark, trade, monkeypatch):
    expected = {(r["id"], r["pagerank"]) for r in driver_queries._rounded(pagerank(views.trade_edges(spark, trade))).collect()}
    seen = []
    monkeypatch.setattr(driver_queries, "pagerank", lambda edges, **how: seen.append(edges.dtypes) or pagerank(edges, **how))
    assert {tuple(r) for r in driver_queries.pagerank_all(spark, trade).collect()} == expected
    monkeypatch.setattr(views, "trade_keys_fit", lambda spark, sf: False)
    assert {tuple(r) for r in driver_queries.pagerank_all(spark, trade).collect()} == expected
    assert seen == [[("src", t), ("dst", t)] if t == "bigint" else [("src", t), ("dst", t), ("weight", "bigint")] for t in ("bigint", "string")]


def test_pagerank_of_given_vertices_and_no_edges(spark):
    e = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (1, 4)], "src int, dst int")
    v = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "id long")
    found = {r["id"]: r["pagerank"] for r in pagerank(e, 0.5, 1, v).collect()}
    # 3 is no vertex and sends nothing; half of what 1 sends goes to 4, which is none either.
    total = 1.0 + 0.75 + 0.5 + 0.5
    assert found == pytest.approx({1: 4 / total, 2: 3 / total, 5: 2 / total, None: 2 / total})
    assert {r["id"]: r["pagerank"] for r in pagerank(e.limit(0), 0.5, 1, v).collect()} == pytest.approx(dict.fromkeys([1, 2, 5, None], 1.0))
    assert pagerank(e.limit(0)).collect() == []


def test_graph_build_and_triplets(spark, rows):
    v = spark.createDataFrame([(1, 9)], "id long, value long")
    e = spark.createDataFrame([(1, 2)], "src long, dst long")
    added = graph_build(v, e, {"value": F.lit(1)})
    assert rows(added[0]) == [(1, 9), (2, 1)]
    assert rows(triplets(*added)) == [(1, 2, 9, 1)]
    assert graph_build(v, e, dangling="drop")[1].count() == 0


def test_rounds_write_changed_vertices_only(spark):
    n = 20
    chain = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).cast("long").alias("weight"))
    vertices = spark.range(4000)
    trace = []
    found = shortest_costs(chain, 0, vertices=vertices, trace=trace)
    assert {r["id"]: r["dist"] for r in found.collect()} == {i: i if i < n else None for i in range(4000)}
    assert [t["messages"] for t in trace] == [1] * (n - 1) + [0]
    # Each of the 19 changed rows is written once, and again for each level of merged tables.
    assert n - 1 <= trace[-1]["written"] <= 4 * (n - 1)


def test_changes_that_reach_all_vertices_are_folded(spark, rows):
    edges = spark.createDataFrame([(i, (i + 1) % 12) for i in range(12)], "src long, dst long")
    vertices = spark.createDataFrame([(i, i) for i in range(12)], "id long, value long")
    trace = []
    found = pregel(
        vertices, edges, start=F.lit(True), message=F.col("src.value"), merge=F.max,
        accept=F.col("msg") > F.col("state.value"), update={"value": F.col("msg")}, trace=trace,
    )
    assert rows(found) == [(i, 11) for i in range(12)]
    assert len(trace) == 12


def test_buckets_against_dijkstra(spark, random_edges):
    best = dijkstra(random_edges, 5)
    for width in (None, 2):
        found = shortest_costs_by_bucket(frame(spark, random_edges), 5, width=width).collect()
        assert {r["id"]: r["dist"] for r in found if r["dist"] is not None} == best


def test_buckets_send_less_along_uneven_weights(spark):
    # A chain improves vertex k in each of k rounds; all vertices have dear edges to many others.
    n, edges = 10, []
    for i in range(n):
        edges += [(i, j, 1 if j == i + 1 else 3 * (j - i)) for j in range(i + 1, n)]
        edges += [(i, 1000 + 20 * i + k, 500) for k in range(20)]
    plain, buckets = [], []
    a = shortest_costs(frame(spark, edges), 0, trace=plain).collect()
    b = shortest_costs_by_bucket(frame(spark, edges), 0, width=40, trace=buckets).collect()
    assert sorted(a) == sorted(b)
    assert sum(t["messages"] for t in buckets) * 2 < sum(t["messages"] for t in plain)


def test_buckets_odd_inputs(spark):
    def found(edges, source=1, **more):
        return sorted((r["id"], r["dist"]) for r in shortest_costs_by_bucket(frame(spark, edges), source, **more).collect())

    assert found([]) == []
    assert found([(1, 2, 0), (2, 3, 0)]) == [(1, 0), (2, 0), (3, 0)]
    assert found([(1, 2, None), (1, 3, 4), (1, 3, 2)])[1:] == [(2, None), (3, 2)]
    assert found([(1, 2, 1)], source=9) == [(1, None), (2, None)]
    with pytest.raises(ValueError):
        found([(1, 2, -1)])
    with pytest.raises(ValueError):
        found([(1, 2, 1)], width=0)


def test_a_round_shuffles_messages_only(spark):
    chain = spark.range(200).select("id", F.lit(None).cast("long").alias("dist"))
    state = VertexState(chain.unionByName(chain.limit(3)))
    with planned_shuffles(spark):
        met = state.meet(spark.range(50).groupBy("id").agg(F.count("*").alias("msg")))
        plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("Exchange") == 1  # of the messages
    assert "Sort " not in plan.split("InMemoryRelation")[0].split("InMemoryTableScan")[-1]
    assert met.count() == 50 and state.size == 200
    state.release()


def test_numbered_trade_graph_has_the_same_costs(spark, tmp_path, rows):
    def tables(at, last):
        cells = {
            "orders": ([(0, 1), (0, 2), (None, 3), (-7, 4), (last, 5), (0, None)], "o_custkey long, o_orderkey long"),
            "lineitem": (
                [(1, 10, 20, 1, 5.0), (1, 10, 20, 3, 9.0), (2, 10, 21, None, None), (2, 11, 21, 2, 4.0), (None, 12, 22, 1, 1.0), (5, 13, None, 1, 1.0)],
                "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double",
            ),
            "supplier": ([(20, 0), (21, 1), (22, None)], "s_suppkey long, s_nationkey long"),
            "customer": ([(0, 0), (-7, 1), (last, 1)], "c_custkey long, c_nationkey long"),
        }
        for name, (data, schema) in cells.items():
            spark.createDataFrame(data, schema).write.parquet(f"{at}/{name}.parquet")
        return str(at)

    for last, fits in ((2**59 - 1, True), (2**59, False)):
        sf = tables(tmp_path / str(last), last)
        assert views.trade_keys_fit(spark, sf) == fits
        expected = rows(shortest_costs(views.trade_edges(spark, sf), "C0").select("id", F.coalesce("dist", F.lit(-1))))
        assert ("C-7", 9) in expected and (f"C{last}", 9) in expected
        assert rows(driver_queries.sssp_cost(spark, sf).select("id", F.coalesce("dist", F.lit(-1)))) == expected
    whole = str(tmp_path / str(2**59 - 1))
    numbered = views.trade_edges_numbered(spark, whole)
    assert dict(numbered.dtypes)["src"] == "bigint"
    named = numbered.groupBy(views.trade_name("src").alias("src"), views.trade_name("dst").alias("dst")).agg(F.min("weight").alias("weight"))
    same = views.trade_edges(spark, whole)
    assert named.exceptAll(same).isEmpty() and same.exceptAll(named).isEmpty()
    costs = driver_queries.shortest_costs_by_bucket(views.trade_edges(spark, whole), "C0")
    found = driver_queries.sssp_buckets(spark, whole)
    assert found.exceptAll(costs).isEmpty() and costs.exceptAll(found).isEmpty()
    eighths = driver_queries.sssp_cost_fractional(spark, whole).select("id", (F.col("dist") * 8).cast("long").alias("dist"))
    exact = driver_queries.sssp_cost(spark, whole)
    assert eighths.exceptAll(exact).isEmpty() and exact.exceptAll(eighths).isEmpty()


def test_hot_keys_are_counted_where_a_hash_is_full(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 50 + [(None,)] * 90 + [(str(i),) for i in range(10)], "k string")
    assert hot_keys(df, "k", 10) == [("a", 60)]  # a share is 210 / 4 rows
    assert hot_keys(df, "k", 60) == []
    assert hot_keys(df.filter("k IS NULL"), "k", 10) == []
