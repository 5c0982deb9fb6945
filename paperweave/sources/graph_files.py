"""Line-based graph files: tab-separated pairs in, N-Triples out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def split_pairs(lines: DataFrame, left: str, right: str, line: str = "value") -> DataFrame:
    """Cut each line at its first tab; lines without a tab are dropped."""
    at = F.instr(line, "\t")
    return lines.filter(at > 0).select(
        F.substring_index(line, "\t", 1).alias(left),
        F.substring(F.col(line), at + 1, F.length(line)).alias(right),
    )


def read_pairs(spark: SparkSession, path: str, left: str = "src", right: str = "dst") -> DataFrame:
    return split_pairs(spark.read.text(path), left, right)


def _escaped(text: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


# What the grammar of N-Triples keeps out of IRIs unless it is written as \\uXXXX.
_NOT_IN_IRI = r'[\x00-\x20<>"{}|^`\\]'


def _iri(text: Column) -> Column:
    def sign(c: Column) -> Column:
        return F.when(c.rlike(_NOT_IN_IRI), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c)), 4, "0"))).otherwise(c)

    signs = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.when(text.rlike(_NOT_IN_IRI), F.array_join(F.transform(signs, sign), "")).otherwise(text)


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One N-Triples line per row of ``s, p, o, o_is_literal``, whatever signs the IRIs hold."""
    iri = lambda c: F.concat(F.lit("<"), _iri(F.col(c)), F.lit(">"))
    obj = F.when(F.col("o_is_literal"), F.concat(F.lit('"'), _escaped(F.col("o")), F.lit('"')))
    return triples.select(
        F.concat_ws(" ", iri("s"), iri("p"), obj.otherwise(iri("o")), F.lit(".")).alias("line")
    )


def write_ntriples(triples: DataFrame, path: str, compression: str = "gzip", file_lines: int = 1_000_000) -> None:
    """Lines repeat most of their IRIs, so files are compressed (``none`` for plain ones).

    A compressed file is read by one task, hence no file has more than ``file_lines`` lines.
    """
    lines = ntriples_lines(triples).withColumnRenamed("line", "value")
    lines.write.mode("overwrite").option("compression", compression).option("maxRecordsPerFile", file_lines).text(path)
