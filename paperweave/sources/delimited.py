"""Delimited text: tolerant reads, typed headers, one output per record type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import CELL_SEPARATOR, join_cell, split_cell
from .quoted_records import quoted_records

# Header type names and what they mean.
HEADER_TYPES = {
    "any": T.StringType(),
    "string": T.StringType(),
    "integer": T.LongType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
}

_SURPLUS = "_surplus_field"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    sep: str = ";",
    header: bool = True,
    max_rows: int | None = None,
    quoted_breaks: bool = False,
) -> DataFrame:
    """Rows with more fields than the schema are skipped, rows without any value dropped.

    Short rows are padded with nulls.  ``max_rows`` is off by default.  The
    read is splittable, with ``quoted_breaks`` too: quoted fields may then hold
    line breaks (see ``quoted_records``).
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    tolerant = T.StructType([*schema.fields, T.StructField(_SURPLUS, T.StringType())])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    records = quoted_records(spark, path, sep, header) if quoted_breaks else None
    if records is None:
        rows = spark.read.schema(tolerant).options(header=header, enforceSchema=True, **options).csv(path)
    else:
        ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in tolerant.fields)
        rows = records.select(F.from_csv("value", ddl, options).alias("row")).select("row.*")
    rows = rows.filter(F.col(_SURPLUS).isNull()).drop(_SURPLUS).dropna(how="all")
    return rows.limit(max_rows) if max_rows is not None else rows


def parse_typed_header(line: str, sep: str = ";") -> T.StructType:
    """``col:type;col:type[]`` → schema; a column without a type is a string."""
    fields = []
    for entry in line.strip().split(sep):
        name, _, kind = entry.partition(":")
        many = kind.endswith("[]")
        base = HEADER_TYPES.get(kind.removesuffix("[]").lower(), T.StringType())
        fields.append(T.StructField(name, T.ArrayType(base) if many else base))
    return T.StructType(fields)


def read_with_header_file(
    spark: SparkSession, path: str | list[str], header_path: str, sep: str = ";", **options
) -> DataFrame:
    """Names and types from a one-line sidecar file; ``[]`` columns become arrays."""
    line = spark.read.text(header_path).first()[0]
    schema = parse_typed_header(line, sep)
    flat = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
            for f in schema.fields
        ]
    )
    rows = read_delimited(spark, path, flat, sep, header=False, **options)
    return rows.select(
        *[
            split_cell(f.name).try_cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    """Quote where needed, double inner quotes, missing as empty, arrays as cells."""
    flat = df.select(
        *[
            join_cell(f.name, CELL_SEPARATOR).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    (
        flat.write.mode("overwrite")
        .option("sep", sep)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )


def write_per_type(wide: dict[str, DataFrame], folder: str, sep: str = ";") -> dict[str, str]:
    """One delimited output per record type; returns the folder of each."""
    paths = {}
    for record_type, df in wide.items():
        paths[record_type] = f"{folder}/{record_type}"
        write_delimited(df, paths[record_type], sep)
    return paths
