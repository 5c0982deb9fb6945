"""What the operators share: batches of rows, words, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship

MIX = np.uint64(0x9E3779B97F4A7C15)
WORD_CACHE = 200_000
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def draw(identity: Column, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``: the fold a row belongs to."""
    return F.pmod(F.crc32(identity.cast("string").cast("binary")), F.lit(parts))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and gives joins an exact size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_rows(df: DataFrame, handle: Callable[[Iterable[tuple]], Iterator[tuple]], schema: str, flush: int = 2000) -> DataFrame:
    """``handle`` gets the rows of a partition one by one and yields result rows.

    Rows travel in Arrow batches; results leave in batches of at most ``flush`` rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def batches(source):
        def rows():
            for batch in source:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))

        out = []
        for row in handle(rows()):
            out.append(row)
            if len(out) >= flush:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return df.mapInArrow(batches, schema)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered for words that come again; bounded."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORD_CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z (what bytes methods do)."""
    return text.lower().split()


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(size, n)
    folded = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        folded = mixed(folded * MIX + hashes[k : n - width + 1 + k])
    return np.unique(folded)


def without(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` less the ids of which no row of ``decisions(id, kept)`` is kept; null is an id like others, any columns may be there."""
    rows = decisions.groupBy(F.col(id_col).alias("_dropped")).agg(F.max("kept").alias("_kept"))
    dropped = stored(rows.filter("not _kept").select("_dropped"), "dropped")
    return docs.alias("own").join(dropped.alias("gone"), F.col(f"own.{id_col}").eqNullSafe(F.col("gone._dropped")), "left_anti")
