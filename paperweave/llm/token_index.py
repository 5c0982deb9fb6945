"""Token ids in raw shards, with a minimal perfect hash index over document keys.

Shards hold ids one after another in ascending document order. The index gives each key a slot of its own
(a bitmap cascade: a key takes the first level where nobody else wants its bit; its slot is
the number of bits before), and the slot holds a fingerprint of the key, the shard, the place
and the length. Finding a key costs a few hashes whatever the number of documents.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions
from .common import map_rows, mixed, stored
from .tokens import encoder

HEADER = "<8sI"  # magic, bytes of an id
MAGIC = b"TOKENIDS"
BUCKET_KEYS = 20_000
LOAD = 1.5
STEP = np.uint64(0xD1B54A32D192ED03)


def _open(path: str):
    """File system and path for a path or URI of the shared folder."""
    return fs.FileSystem.from_uri(path)


def write_shards(docs: DataFrame, path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all texts; gives ``(id, turn, shard, file, width, offset, n)`` of what was written.

    Documents are dealt to shards by ranges of the id and written in ascending order, nulls first; a null
    text has the end id only. Rows that repeat an id follow each other, told apart by ``turn``. Each
    attempt of a task writes a file of its own; only files of committed attempts are named in the result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    dealt = texts.repartitionByRange(shuffle_partitions(docs.sparkSession), "id").sortWithinPartitions("id", "text")

    def write(rows):
        known, shard, name = encoder(path), TaskContext.get().partitionId(), f"shard-{uuid.uuid4().hex}.ids"
        end, offset, last, turn = np.array([end_id], known.dtype).tobytes(), struct.calcsize(HEADER), (), 0
        system, place = _open(folder)
        system.create_dir(place, recursive=True)
        with system.open_output_stream(f"{place}/{name}", buffer_size=1 << 20) as out:
            out.write(struct.pack(HEADER, MAGIC, known.dtype.itemsize))
            for identity, text in rows:
                turn = turn + 1 if last == (identity,) else 0
                last = (identity,)
                data = known.encode(text.decode("utf-8", "replace") if text else "") + end
                out.write(data)
                yield identity, turn, shard, name, known.dtype.itemsize, offset, len(data) // known.dtype.itemsize
                offset += len(data)

    return stored(map_rows(dealt, write, "id long, turn int, shard int, file string, width int, offset long, n long"), "written")


def with_starts(written: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before. The driver sees one sum for each shard."""
    base, total = [], 0
    for r in written.groupBy("shard").agg(F.sum("n").alias("n"), F.max("width").alias("width")).orderBy("shard").collect():
        base.append((r["shard"], total))
        total += r["n"]
    bases = written.sparkSession.createDataFrame(base, "shard int, base long")
    inside = ((F.col("offset") - struct.calcsize(HEADER)) / F.col("width")).cast("long")
    return written.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + inside)  # a row for each shard


def _key(identity, turn) -> bytes:
    return f"{identity}#{turn}".encode()


def _hashes(ids, turns) -> tuple[np.ndarray, np.ndarray]:
    both = [xxhash.xxh3_128_intdigest(_key(i, t)) for i, t in zip(ids, turns)]
    return np.array([b >> 64 for b in both], np.uint64), np.array([b & (2**64 - 1) for b in both], np.uint64)


def build(high: np.ndarray, low: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """``(level sizes, bitmap, slot of each key)`` for distinct keys."""
    sizes, maps, slots = [], [], np.zeros(len(low), np.int64)
    left, before, level = np.arange(len(low)), 0, 0
    while len(left):
        size = max(8, int(LOAD * len(left)) + 7 & ~7)
        at = (_spot(high[left], low[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        slots[left[mine]] = before + np.cumsum(alone)[at[mine]] - 1
        before += int(alone.sum())
        sizes.append(size)
        maps.append(np.packbits(alone))
        left, level = left[~mine], level + 1
    return sizes, b"".join(m.tobytes() for m in maps), slots


def _spot(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    return mixed(low + high * np.uint64(2 * level + 1) + np.uint64(int(STEP) * level % 2**64))


def find(sizes: list[int], bitmap: bytes, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where no level takes it."""
    bits = np.unpackbits(np.frombuffer(bitmap, np.uint8))
    rank = np.cumsum(bits, dtype=np.int64)
    slots, start = np.full(len(low), -1, np.int64), 0
    for level, size in enumerate(sizes):
        at = start + (_spot(high, low, level) % np.uint64(size)).astype(np.int64)
        hit = (slots < 0) & (bits[at] == 1)
        slots[hit] = rank[at[hit]] - 1
        start += size
    return slots


def _fingerprints(high: np.ndarray) -> np.ndarray:
    return (mixed(high ^ STEP) >> np.uint64(32)).astype(np.uint32)


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "turn"), F.lit(buckets)))


def build_index(written: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row ``(bucket, buckets, sizes, bitmap, slots)`` for each bucket of about ``bucket_keys`` keys."""
    buckets = max(1, -(-written.count() // bucket_keys))

    def pack(group):
        import pyarrow as pa

        ids, turns, files = (group.column(c).to_pylist() for c in ("id", "turn", "file"))
        high, low = _hashes(ids, turns)
        sizes, bitmap, slots = build(high, low)
        names = sorted(set(files))
        entries = np.zeros(len(ids), ENTRY)
        entries["print"][slots] = _fingerprints(high)
        entries["file"][slots] = [names.index(f) for f in files]
        for column in ("offset", "n", "start"):
            entries[column][slots] = group.column(column).to_numpy()
        row = {"bucket": [group.column("bucket")[0].as_py()], "buckets": [buckets], "sizes": [sizes], "bitmap": [bitmap],
               "files": [names], "entries": [entries.tobytes()]}
        return pa.table(row, schema=pa.schema([("bucket", pa.int64()), ("buckets", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bitmap", pa.binary()), ("files", pa.list_(pa.string())), ("entries", pa.binary())]))

    schema = "bucket long, buckets long, sizes array<long>, bitmap binary, files array<string>, entries binary"
    return stored(_bucketed(written, buckets).groupBy("bucket").applyInArrow(pack, schema), "index")


ENTRY = np.dtype([("print", "<u4"), ("file", "<u4"), ("offset", "<u8"), ("n", "<u8"), ("start", "<u8")])


def lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """``(id, turn, file, offset, n, start)`` of each of ``keys(id, turn)`` that the index holds."""
    first = index.select("buckets").first()
    schema = "id long, turn int, file string, offset long, n long, start long"
    if first is None:
        return keys.sparkSession.createDataFrame([], schema)

    def probe(asked, held):
        import pyarrow as pa

        kinds = pa.schema([("id", pa.int64()), ("turn", pa.int32()), ("file", pa.string()), ("offset", pa.int64()), ("n", pa.int64()), ("start", pa.int64())])
        if not asked.num_rows or not held.num_rows:
            return kinds.empty_table()
        ids, turns = asked.column("id").to_pylist(), asked.column("turn").to_pylist()
        high, low = _hashes(ids, turns)
        slots = find(held.column("sizes")[0].as_py(), held.column("bitmap")[0].as_py(), high, low)
        entries = np.frombuffer(held.column("entries")[0].as_py(), ENTRY)
        files = held.column("files")[0].as_py()
        got = entries[np.maximum(slots, 0)]
        ok = np.flatnonzero((slots >= 0) & (got["print"] == _fingerprints(high)))
        got = got[ok]
        columns = [[ids[k] for k in ok], [turns[k] for k in ok], [files[f] for f in got["file"]]]
        columns += [got[c].astype(np.int64) for c in ("offset", "n", "start")]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    asked = _bucketed(keys, first["buckets"])
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(probe, schema)


def read_ids(found: DataFrame, folder: str) -> DataFrame:
    """``(id, turn, start, n, ids)``: the ids of each place that ``lookup`` found, little-endian unsigned 32-bit."""
    parts = shuffle_partitions(found.sparkSession)
    places = found.repartition(parts, "file").sortWithinPartitions("file", "offset").select("id", "turn", "file", "offset", "n", "start")

    def read(rows):
        system, place = _open(folder)
        name = source = None
        for identity, turn, file, offset, n, start in rows:
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, system.open_input_file(f"{place}/{file}")
                magic, width = struct.unpack(HEADER, source.read(struct.calcsize(HEADER)))
                if magic != MAGIC:
                    raise ValueError(f"{file} holds no token ids")
            source.seek(offset)
            yield identity, turn, start, n, np.frombuffer(source.read(n * width), f"<u{width}").astype("<u4").tobytes()
        if source is not None:
            source.close()

    return map_rows(places, read, "id long, turn int, start long, n long, ids binary", flush=500)


def token_index(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Writes shards and index below the shared folder; gives the index and the shards' folder."""
    folder = scratch_path(docs.sparkSession, "shards")
    return build_index(with_starts(write_shards(docs, path, end_id, folder, id_col, text_col))), folder


def document_keys(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, turn)`` of all rows: repeated ids are numbered from 0."""
    counts = docs.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.count("*").cast("int").alias("rows"))
    return counts.select("id", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("turn"))
