"""Edges in blocks for rounds in which every edge carries a number.

A vertex lives in the block its id hashes to, as a place in the block's vector;
an edge lives with its source. Which destinations a block sends to is the same
in each round, so their ids travel once: afterwards a message is one row for a
pair of blocks with the sums of all its destinations, 8 bytes each, in an order
that both sides know. Spark cuts, sorts and shuffles the blocks, numpy adds within one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, planned_shuffles, release_unused, shuffle_partitions, ship
from .graph import endpoints
from .skew import MIN_HOT_ROWS

# Edges that a block should have at most; more edges make more blocks. A worker holds one block at a time.
BLOCK_EDGES = 1 << 20

# Hashes that sources are counted by, for each partition.
_HASHES = 16

# Rows of the layout by kind: edges of a block, its vertices, the sums it sends to another block, those it gets.
EDGES, VERTICES, TO, FROM, GIVEN, NAMES = range(6)

_MESSAGE = "place int, other int, a binary"
_STATIC = "place int, kind int, other int, a binary, b binary"


def _ints(values) -> bytes:
    return np.ascontiguousarray(values, dtype=np.int32).tobytes()


def _read(cell, kind=np.int32) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), dtype=kind)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _parts(table: pa.Table, kind: int) -> list[dict]:
    """The rows of one kind; cells stay in Arrow."""
    rows = table.filter(pc.equal(table["kind"], kind))
    return [{c: rows[c][i] for c in rows.column_names} for i in range(rows.num_rows)]


class RankBlocks:
    """The layout of ``edges`` (``src, dst``), and the two steps of a round on it.

    Without ``vertices`` all ends of edges are vertices; with them, others neither
    send nor are in the result. Parallel edges count, or with ``parallel=False`` are one. A source with more than a block's share of all edges is a
    vertex of several blocks, each with a part of its edges; there are at most two such places a block.
    ``edges`` is read twice. What a step of the layout leaves behind is dropped before the next: the tables of blocks are checkpoints.
    """

    def __init__(
        self, edges: DataFrame, vertices: DataFrame | None = None, block_edges: int = BLOCK_EDGES, min_hot_rows: int = MIN_HOT_ROWS, parallel: bool = True
    ):
        spark = edges.sparkSession
        ship(spark)
        self.parts = shuffle_partitions(spark)
        ends = edges.filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst")
        named = endpoints(ends) if vertices is None else vertices.select("id").union(endpoints(ends))
        self.id_type = named.schema["id"].dataType
        ends = ends.select(F.col("src").cast(self.id_type).alias("src"), F.col("dst").cast(self.id_type).alias("dst"))
        hashed = F.pmod(F.xxhash64("src"), F.lit(self.parts * _HASHES))
        by_hash = ends.groupBy(hashed.alias("h")).agg(F.count("*").alias("n")).collect()
        self.edges = sum(r["n"] for r in by_hash)
        self.blocks = max(min(self.parts, 2 * spark.sparkContext.defaultParallelism), -(-self.edges // block_edges))
        # A hub shows in the count of its hash, so most tables need no count by source.
        share = max(min_hot_rows, self.edges // self.blocks, 1)
        hubs = {}
        if heavy := [r["h"] for r in by_hash if r["n"] > share]:
            if not parallel:
                ends = ends.distinct()  # else a block does it, but copies of one edge can't be spread over blocks
            found = ends.filter(hashed.isin(heavy)).groupBy("src").agg(F.count("*").alias("n"))
            hubs = {r["src"]: r["n"] for r in found.filter(F.col("n") > share).collect()}  # at most one a block
        self._lay_out(ends, vertices, hubs, share, parallel)

    def _home(self, column: str, cut: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(column), F.lit(0) if cut is None else cut), F.lit(self.blocks)).cast("int")

    def _lay_out(self, ends: DataFrame, vertices: DataFrame | None, hubs: dict, share: int, parallel: bool) -> None:
        spark, hub_rows = ends.sparkSession, []
        if hubs:
            schema = T.StructType([T.StructField("hub", self.id_type), T.StructField("cuts", T.IntegerType()), T.StructField("degree", T.LongType())])
            listed = spark.createDataFrame([(k, -(-n // share), n) for k, n in hubs.items()], schema)
            cut = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.pmod(F.xxhash64("hub", k), F.lit(self.blocks)).cast("int"))
            listed = listed.withColumn("places", F.array_distinct(cut))
            hub_rows = [(r["hub"], r["degree"], r["places"]) for r in listed.collect()]
            slices = ends.join(F.broadcast(listed.select(F.col("hub").alias("src"), "cuts")), "src", "left")  # at most a row a block
            ends = slices.withColumn("place", self._home("src", F.coalesce(F.pmod(F.xxhash64("dst"), F.col("cuts")).cast("int"), F.lit(0)))).drop("cuts")
        else:
            ends = ends.withColumn("place", self._home("src"))
        arrow_type = T.StructType([T.StructField("ids", T.ArrayType(self.id_type))])
        layout = T.StructType([*T.StructType.fromDDL(_STATIC).fields, *arrow_type.fields])
        with planned_shuffles(spark):
            ends = ends.select("place", "src", "dst").repartition(self.parts, "place").withColumn("to", self._home("dst"))
            packed = cut_lineage(ends.groupBy("place").applyInArrow(_packer(hub_rows, parallel), layout))
            release_unused(spark)
            rows = packed.filter(F.col("kind").isin(VERTICES, FROM)).select("place", "kind", "other", "a", "b", "ids")
            if vertices is not None:
                given = vertices.select(F.col("id").cast(self.id_type).alias("id")).distinct()
                places = F.array(self._home("id"))
                if hubs:
                    given = given.join(F.broadcast(listed.select(F.col("hub").alias("id"), "places")), "id", "left")
                    places = F.coalesce("places", places)
                given = given.select(F.explode(places).alias("place"), F.lit(GIVEN).alias("kind"), F.lit(None).cast("int").alias("other"), F.lit(None).cast("binary").alias("a"), F.lit(None).cast("binary").alias("b"), F.array("id").alias("ids"))
                rows = rows.unionByName(given)
            met = cut_lineage(rows.groupBy("place").applyInArrow(_numberer(hub_rows, vertices is not None), layout))
            release_unused(spark)
            static = packed.filter(F.col("kind").isin(EDGES, TO)).unionByName(met.filter(F.col("kind").isin(VERTICES, FROM))).drop("ids")
            self.names = cut_lineage(met.filter(F.col("kind") == NAMES).select("place", "a", "ids").repartition(self.parts, "place"))
            self.static = cut_lineage(static.repartition(self.parts, "place"))
        del packed, met, rows, static
        release_unused(spark)

    def ranks(self, arrived: DataFrame | None, resets: list[float]) -> DataFrame:
        """A row a block with the ranks of its vertices: 1 each at the start, else by the messages of ``send``."""
        return self._step(arrived, resets, _ranker)

    def send(self, arrived: DataFrame | None, resets: list[float]) -> DataFrame:
        """The messages of a round, one row a pair of blocks. ``arrived`` is what ``send`` or ``ranks`` gave before."""
        return self._step(arrived, resets, _sender)

    def _step(self, arrived: DataFrame | None, resets: list[float], make) -> DataFrame:
        step, blocks = make(resets), self.static.groupBy("place")
        if arrived is None:
            return blocks.applyInArrow(lambda table: step(table, None), _MESSAGE)
        return blocks.cogroup(arrived.groupBy("place")).applyInArrow(step, _MESSAGE)

    def named(self, ranks: DataFrame, columns: list[str]) -> DataFrame:
        """``id`` and the ranks, a row a vertex, of what ``ranks`` gave."""
        schema = T.StructType([T.StructField("id", self.id_type), *[T.StructField(c, T.DoubleType()) for c in columns]])

        def rows(names: pa.Table, found: pa.Table) -> pa.Table:
            ids, shown = _flat(names["ids"]).flatten(), pa.array(_read(names["a"][0], np.bool_))
            values = _read(found["a"][0], np.float64).reshape(len(columns), -1)
            return pa.Table.from_arrays([ids, *[pa.array(v) for v in values]], names=["id", *columns]).filter(shown)

        return self.names.groupBy("place").cogroup(ranks.groupBy("place")).applyInArrow(rows, schema)

    def release(self) -> None:
        """Lets go of the layout; frames made of it can't be run after."""
        spark, self.static, self.names = self.static.sparkSession, None, None
        release_unused(spark)


def _table(rows: list[tuple], id_type: pa.DataType) -> pa.Table:
    place, kind, other, a, b, ids = zip(*rows)
    lists = [pa.nulls(0, id_type) if x is None else x for x in ids]
    ends = np.cumsum([0, *[len(x) for x in lists]])
    cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(lists))
    columns = [*[pa.array(c, pa.int32()) for c in (place, kind, other)], *[pa.array(c, pa.binary()) for c in (a, b)], cells]
    return pa.Table.from_arrays(columns, names=["place", "kind", "other", "a", "b", "ids"])


def _packer(hubs: list[tuple], parallel: bool):
    """The edges of a block → its sources, edges as numbers, and for each other block the destinations there."""

    def pack(table: pa.Table) -> pa.Table:
        here = table["place"][0].as_py()
        src, dst = (_flat(table[c].combine_chunks().dictionary_encode()) for c in ("src", "dst"))
        codes, slots = (d.indices.to_numpy(zero_copy_only=False).astype(np.int32) for d in (src, dst))
        to = np.zeros(len(dst.dictionary), np.int32)
        to[slots] = _flat(table["to"]).to_numpy(zero_copy_only=False)
        # Destinations are numbered by their blocks, so what goes to a block is a range of the sums.
        order = np.argsort(to, kind="stable")
        ids, kind, to = dst.dictionary.take(pa.array(order)), dst.dictionary.type, to[order]
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        # Sorted by source, so the counts say where an edge starts.
        both = codes.astype(np.int64) * len(ids) + number[slots]
        if parallel:
            both.sort()
        else:
            both = np.unique(both)
        degree = np.bincount(both // len(ids), minlength=len(src.dictionary)).astype(np.int64)
        counts = _ints(degree)  # of a hub less than its degree
        bounds = np.flatnonzero(np.diff(to, prepend=-1, append=-1)).tolist()
        sent = {int(to[start]): (start, end) for start, end in zip(bounds, bounds[1:])}
        for hub, rows, places in hubs:
            value = pa.scalar(hub, kind)
            if (at := pc.index(src.dictionary, value).as_py()) >= 0:
                degree[at] = rows
            if (at := pc.index(ids, value).as_py()) >= 0:
                for place in places:
                    if place != to[at]:
                        sent[place] = (*sent.get(place, (0, 0)), at)
        rows = [(here, VERTICES, None, degree.tobytes(), counts, src.dictionary)]
        rows.append((here, EDGES, None, _ints(both % len(ids)), None, None))
        for place, (start, end, *single) in sent.items():
            rows.append((here, TO, place, _ints([start, end, *single]), _ints([len(ids)]), None))
            part = ids.slice(start, end - start)
            rows.append((place, FROM, here, None, None, pa.concat_arrays([part, ids.take(pa.array(single, pa.int32()))]) if single else part))
        return _table(rows, kind)

    return pack


def _numberer(hubs: list[tuple], only_given: bool):
    """Sources of a block, and destinations that others name → the places of both in the block's vector."""

    def number(table: pa.Table) -> pa.Table:
        here, kind = table["place"][0].as_py(), table.schema.field("ids").type.value_type
        own = _parts(table, VERTICES)
        senders = own[0]["ids"].values if own else pa.nulls(0, kind)
        every = _flat(table.filter(pc.not_equal(table["kind"], VERTICES))["ids"]).flatten().unique()
        rest = every.filter(pc.invert(pc.is_in(every, value_set=senders)))
        ids = pa.concat_arrays([senders, rest])
        degree = np.zeros(len(ids), np.int64)
        if own:
            degree[: len(senders)] = _read(own[0]["a"], np.int64)
        known = np.ones(len(ids), np.bool_)
        if only_given:
            given = _flat(table.filter(pc.equal(table["kind"], GIVEN))["ids"]).flatten()
            known = pc.is_in(ids, value_set=given).to_numpy(zero_copy_only=False)
            degree[~known] = 0
        shown = known.copy()
        for hub, _, places in hubs:
            if places[0] != here and (at := pc.index(ids, pa.scalar(hub, kind)).as_py()) >= 0:
                shown[at] = False
        counts = own[0]["b"].as_py() if own else b""
        rows = [(here, VERTICES, None, degree.tobytes(), counts, None), (here, NAMES, None, shown.tobytes(), None, ids)]
        for part in _parts(table, FROM):
            rows.append((here, FROM, part["other"].as_py(), _ints(pc.index_in(part["ids"].values, value_set=ids)), None, None))
        return _table(rows, kind)

    return number


def _received(table: pa.Table, arrived: pa.Table | None, resets: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Degrees, and a row of ranks for each reset probability."""
    degree = _read(_parts(table, VERTICES)[0]["a"], np.int64)
    if arrived is None:
        return degree, np.ones((len(resets), len(degree)))
    places = {p["other"].as_py(): p["a"] for p in _parts(table, FROM)}
    sums = np.zeros((len(resets), len(degree)))
    for i in range(arrived.num_rows):
        other, values = arrived["other"][i].as_py(), _read(arrived["a"][i], np.float64).reshape(len(resets), -1)
        if other < 0:
            return degree, values
        sums[:, _read(places[other])] += values  # a sender names a destination once
    reset = np.array(resets)[:, None]
    return degree, reset + (1.0 - reset) * sums


def _messages(rows: list[tuple]) -> pa.Table:
    place, other, a = zip(*rows) if rows else ((), (), ())
    return pa.Table.from_arrays([pa.array(place, pa.int32()), pa.array(other, pa.int32()), pa.array(a, pa.binary())], names=["place", "other", "a"])


def _ranker(resets: list[float]):
    def rank(table: pa.Table, arrived: pa.Table | None) -> pa.Table:
        ranks = _received(table, arrived, resets)[1]
        return _messages([(table["place"][0].as_py(), -1, np.ascontiguousarray(ranks).tobytes())])

    return rank


def _sender(resets: list[float]):
    def send(table: pa.Table, arrived: pa.Table | None) -> pa.Table:
        here, to = table["place"][0].as_py(), _parts(table, TO)
        if not to:
            return _messages([])
        degree, ranks = _received(table, arrived, resets)
        shares = ranks * np.where(degree > 0, 1.0 / np.maximum(degree, 1), 0.0)
        sums = np.zeros((len(resets), int(_read(to[0]["b"])[0])))
        counts, slots = _read(_parts(table, VERTICES)[0]["b"]), _read(_parts(table, EDGES)[0]["a"])
        for share, total in zip(shares, sums):
            total += np.bincount(slots, weights=np.repeat(share[: len(counts)], counts), minlength=len(total))

        def of(start: int, end: int, *single: int) -> bytes:
            part = sums[:, start:end]
            return (np.hstack([part, sums[:, list(single)]]) if single else part).tobytes()

        return _messages([(p["other"].as_py(), here, of(*_read(p["a"]).tolist())) for p in to])

    return send
