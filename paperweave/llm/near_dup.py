"""MinHash near-duplicates with tensored banding.

Two small collections of ``tables_per_side`` minhash tuples are computed for each set of
word shingles; a table key is one tuple of the left collection with one of the
right. So m + m tuples give m * m tables, and the number of minhashes is about the
square root of what as many separate tables would need. Two sets that meet in any table
are compared on their full shingle sets.

A pair of similarity s is missed with probability at most 2 (1 - s^r)^m for
r rows in a tuple: 1e-5 at s = 0.8 with the default r = 2, m = 12.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import MIX, WordHashes, ascii_words, map_rows, mixed, shingles, stored
from .components import connected_components

SLICE = 1 << 15
BLOCK_SHINGLES, SLICE_SHINGLES = 100_000, 400_000


def _tuples(values: np.ndarray, factors: np.ndarray, rows: int) -> list[int]:
    """Minhash tuples of a set, folded to 64 bits each."""
    least = None
    for start in range(0, len(values), SLICE):
        part = values[None, start : start + SLICE] * factors[:, None]
        low = part.min(axis=1)
        least = low if least is None else np.minimum(least, low)
    least = least.reshape(-1, rows)
    folded = np.zeros(len(least), np.uint64)
    for k in range(rows):
        folded = mixed(folded * MIX + least[:, k])
    return folded.view(np.int64).tolist()


def _signatures(rows, size: int, per_side: int, in_tuple: int):
    words = WordHashes()
    factors = np.random.default_rng(7).integers(1, 2**62, 2 * per_side * in_tuple, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for identity, text in rows:
        found = shingles(words.of(ascii_words(text)), size) if text else ()
        if not len(found):
            yield identity, 0, None, None, None
            continue
        tuples = _tuples(found, factors, in_tuple)
        yield identity, len(found), xxhash.xxh3_128_digest(found.tobytes()), tuples[:per_side], tuples[per_side:]


def _sets(rows, size: int):
    words = WordHashes()
    for identity, text in rows:
        yield identity, shingles(words.of(ascii_words(text or b"")), size).view(np.int64)


def _bucket_members(keyed: DataFrame) -> DataFrame:
    """``(key, member, size, leader, leader_size)`` of all buckets with two members or more.

    Rows are sorted by (key, member) over ranges, so a bucket of any size spreads over as
    many tasks as it needs. Each task streams its range and names the first member it sees
    of a key as leader; ends of ranges are always passed on, and the few leaders
    that one key has in neighbouring ranges are then linked with each other.
    """
    parts = shuffle_partitions(keyed.sparkSession)
    ordered = keyed.repartitionByRange(parts, "key", "member").sortWithinPartitions("key", "member")

    def runs(source):
        import pyarrow as pa

        names = ["key", "member", "size", "leader", "leader_size", "edge"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]
        first_key = None
        run = None  # key, leader and its size of a run that goes on from the rows before
        held = None  # the last row, whose run may go on

        def out(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in source:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                rows = [np.concatenate([h, x]) for h, x in zip(held, rows)]
            key, member, size = rows
            first_key = key[0] if first_key is None else first_key
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            lengths = np.diff(np.concatenate([at, [len(key)]]))
            leads, lead_sizes = member[at].copy(), size[at].copy()
            many = np.repeat(lengths > 1, lengths)
            if run is not None:
                leads[0], lead_sizes[0] = run[1:]
                many[: lengths[0]] = True
            lead, lead_size, edge = np.repeat(leads, lengths), np.repeat(lead_sizes, lengths), key == first_key
            pick = np.flatnonzero((many | edge)[:-1])
            if len(pick):
                yield out(*(x[pick] for x in (key, member, size, lead, lead_size, edge)))
            run = (key[-1], lead[-1], lead_size[-1]) if many[-1] else None
            held = [x[-1:] for x in rows]
        if held is not None:
            lead, lead_size = (held[1], held[2]) if run is None else (np.array([run[1]]), np.array([run[2]]))
            yield out(*held, lead, lead_size, np.array([True]))

    schema = "key long, member long, size int, leader long, leader_size int, edge boolean"
    found = stored(ordered.mapInArrow(runs, schema), "buckets")
    leaders = found.filter("edge").select("key", F.struct("leader", "leader_size").alias("lead"))
    first = leaders.groupBy("key").agg(F.min("lead").alias("first"))
    across = leaders.distinct().join(first, "key").filter("lead.leader <> first.leader")
    return found.drop("edge").union(across.select("key", "lead.*", "first.*"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    together = F.size("of_a") + F.size("of_b") - both
    return pairs.join(left, "a").join(right, "b").filter(both * 100 >= together * percent).select("a", "b")


def _pairs(a: str, b: str, size_a: str, size_b: str, percent: int):
    """Filter and columns of candidate pairs: sizes that allow the similarity, smaller id first."""
    fits = F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent
    return (F.col(a) != F.col(b)) & fits, (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    tables_per_side: int = 12,
    rows_in_tuple: int = 2,
    star_rounds: int = 2,
) -> DataFrame:
    """Components of near-duplicates: one row ``(doc_id, n_shingles, component_id, kept)`` per row.

    Texts with equal shingle sets are one set from the start; distinct sets are linked when
    100 * intersection >= percent * union. ``component_id`` is the smallest id reachable over
    links, ``kept`` marks the row that carries it.

    Every set is first compared with one leader of its buckets only, that of the most tables; then for ``star_rounds`` rounds
    one member of each open component with one of the first component of a bucket; sets of a bucket that
    are still in different components after that are all compared, block by block. So no
    link between sets that meet in a table is lost.

    Null or wordless text: no shingles, linked with nothing, kept. Null id: the row cannot be named; it is
    kept only where no row with an id has its set, and else carries that row's component. Rows with the same id count as one document: their
    sets share what they are linked with. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    per_side, in_tuple = tables_per_side, rows_in_tuple
    signed = stored(
        map_rows(
            texts,
            lambda rows: _signatures(rows, shingle_words, per_side, in_tuple),
            "id long, n int, digest binary, heads array<long>, tails array<long>",
        ),
        "signatures",
    )
    named = signed.filter("id is not null and n > 0")
    groups = stored(
        named.groupBy("digest").agg(
            F.min("id").alias("member"), F.count("*").alias("rows"), F.max("n").alias("size"),
            F.first("heads").alias("heads"), F.first("tails").alias("tails"),
        ),
        "sets",
    )
    table_keys = "flatten(transform(heads, (l, i) -> transform(tails, (r, j) -> xxhash64(i, j, l, r))))"
    buckets = stored(_bucket_members(groups.select(F.explode(F.expr(table_keys)).alias("key"), "member", "size")), "members")

    fits, columns = _pairs("leader", "member", "leader_size", "size", percent)
    met = buckets.filter(fits).groupBy("member", "leader").agg(F.count("*").alias("tables"))
    best = met.groupBy("member").agg(F.max(F.struct("tables", "leader")).alias("best"))
    chosen = best.select(F.col("member"), F.col("best.leader").alias("leader"))
    pairs = stored(chosen.select(F.least("leader", "member").alias("a"), F.greatest("leader", "member").alias("b")).distinct(), "pairs")
    wanted = stored(buckets.filter("member <> leader").select("member").union(
        buckets.filter("member <> leader").select("leader")).distinct(), "wanted")
    sets = stored(
        map_rows(
            texts.join(wanted, F.col("id") == F.col("member"), "left_semi"),
            lambda rows: _sets(rows, shingle_words),
            "id long, shingles array<long>",
        ).dropDuplicates(["id", "shingles"]),
        "shingles",
    )
    tested, links = pairs, stored(_verified(pairs, sets, percent), "links")
    members = buckets.select("key", "member", "size")
    parts = connected_components(links)
    for turn in range(star_rounds + 1):
        open_members = stored(_unresolved(members, parts), "open")
        members = open_members.select("key", "member", "size")
        if turn < star_rounds:
            pairs = stored(_stars(open_members, tested, turn, percent), "pairs")
            tested, new = tested.union(pairs), _verified(pairs, sets, percent)
        else:
            new = _rest(open_members, sets, percent)
        found = stored(new, "links")
        if not found.isEmpty():
            links = links.union(found)
            parts = connected_components(links)

    top = groups.join(parts, F.col("member") == F.col("id"), "left").select(
        "digest", F.coalesce("component", "member").alias("top"), "rows", "member"
    )
    top = stored(top.filter("rows > 1 or top <> member").select("digest", "top"), "tops")
    return signed.join(top, "digest", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("top", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("top", "id")).alias("kept"),
    )


def _unresolved(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that hold several components."""
    own = parts.select(F.col("id").alias("member"), "component")
    known = members.join(own, "member", "left").withColumn("component", F.coalesce("component", "member"))
    known = stored(known.distinct(), "known")
    mixed_keys = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed_keys = stored(mixed_keys.filter("low <> high").select("key"), "mixed")
    return known.join(mixed_keys, "key", "left_semi")


def _stars(members: DataFrame, tested: DataFrame, turn: int, percent: int) -> DataFrame:
    """For each open component one pair, of those not yet tested.

    In a bucket a member of each component is paired with one of the bucket's first component; of a component's
    pairs over all buckets that of the most tables is taken, so that pairs grow with the components and not with their tables.
    """
    order = F.struct(F.xxhash64("member", "key", F.lit(turn)).alias("o"), "member", "size")
    one = members.groupBy("key", "component").agg(F.min(order).alias("m"))
    one = stored(one.select("key", "component", "m.*"), "picked")
    lead = one.groupBy("key").agg(F.min(F.struct(F.col("component").alias("c"), F.col("member").alias("leader"), F.col("size").alias("leader_size"))).alias("l"))
    fits, columns = _pairs("leader", "member", "leader_size", "size", percent)
    met = one.join(lead.select("key", "l.*"), "key").filter(fits).select("component", *columns)
    met = met.groupBy("component", "a", "b").agg(F.count("*").alias("tables")).join(tested, ["a", "b"], "left_anti")
    best = met.groupBy("component").agg(F.max(F.struct("tables", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets of open buckets that are still in different components.

    Open buckets with the same largest component form an area; a set is in the area of each of its
    buckets. Within an area every set outside the most frequent component meets all sets, block by block: blocks and slices are cut by
    their number of shingles, so a task holds a bounded part of an area of any size
    and gives out links only, never the pairs it has looked at, and of those only ones between components that no
    link before has joined: fewer than it has components.
    """
    held = stored(members.select("member", "component").distinct().groupBy("component").count(), "held")
    present = stored(members.select("key", "component").distinct().join(held, "component"), "present")
    first = stored(present.groupBy("key").agg(F.max(F.struct("count", "component")).alias("m")).select("key", F.col("m.component").alias("a")), "first")
    own = members.join(first, "key").select(F.col("member").alias("id"), "component", "size", F.col("a").alias("area"))
    own = stored(own.distinct(), "areas")
    counts = own.groupBy("area", "component").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    main = counts.groupBy("area").agg(F.max(F.struct("n", "component", "s")).alias("main"), F.sum("s").alias("all"))
    main = stored(main.select("area", F.col("main.component").alias("main"),
        F.ceil((F.col("all") - F.col("main.s")) / BLOCK_SHINGLES).cast("int").alias("blocks"),
        F.ceil(F.col("all") / SLICE_SHINGLES).cast("int").alias("slices")), "main")
    placed = stored(sets.join(own.join(main, "area").drop("size"), "id"), "placed")

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def part(n):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    row = "area", "block", "slice", "id", "component", "shingles", "asks"
    asks = placed.filter("component <> main").withColumn("block", part("blocks")).withColumn("slice", each("slices"))
    told = placed.withColumn("slice", part("slices")).withColumn("block", each("blocks"))
    both = asks.withColumn("asks", F.lit(True)).select(*row).union(told.withColumn("asks", F.lit(False)).select(*row))

    def compare(group):
        import pyarrow as pa

        ids, parts, asks = (group.column(c).to_pylist() for c in ("id", "component", "asks"))
        column = group.column("shingles").combine_chunks()
        bounds, whole = column.offsets.to_numpy(), column.values.to_numpy()
        lists = [whole[a:b] for a, b in zip(bounds, bounds[1:])]
        x = [i for i, q in enumerate(asks) if q]
        if not x:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        owner = np.repeat(np.arange(len(x)), [len(lists[i]) for i in x])
        values = np.concatenate([lists[i] for i in x])
        order = np.argsort(values, kind="stable")
        owner, values = owner[order], values[order]
        sizes = np.array([len(lists[i]) for i in x])
        number = np.unique(parts, return_inverse=True)[1]
        joined, asking = np.arange(number.max() + 1), number[x]  # of each component the group that links have put it in
        a, b = [], []
        for i in (i for i, q in enumerate(asks) if not q):
            low, high = np.searchsorted(values, lists[i]), np.searchsorted(values, lists[i], "right")
            n = high - low
            at = np.repeat(high - np.cumsum(n), n) + np.arange(n.sum())
            shared = np.bincount(owner[at], minlength=len(x))
            own = joined[number[i]]
            fit = np.flatnonzero((shared * 100 >= (sizes + len(lists[i]) - shared) * percent) & (joined[asking] != own))
            groups, first = np.unique(joined[asking[fit]], return_index=True)
            for k in fit[first]:
                a.append(min(ids[x[k]], ids[i]))
                b.append(max(ids[x[k]], ids[i]))
            if len(groups):
                joined[np.isin(joined, groups)] = own
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return both.groupBy("area", "block", "slice").applyInArrow(compare, "a long, b long").distinct()
