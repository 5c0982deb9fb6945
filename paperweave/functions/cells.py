"""Column expressions for cells: trimming, coercion, splitting, joining, ids."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL_SEPARATOR = "|"

# The characters an IRI segment may not keep.
IRI_UNSAFE = string.punctuation + " "
# A class of signs is looked up much faster than translate() looks up each sign.
_IRI_UNSAFE = f"[{re.escape(IRI_UNSAFE)}]"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(column: str | Column) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.regexp_replace(col(column), r"^\s+|\s+$", "")


def to_year(column: str | Column) -> Column:
    """Whole number from text, null where the text is no plain number."""
    text = strip(col(column).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double").try_cast("int"))


def split_cell(column: str | Column, separator: str = CELL_SEPARATOR) -> Column:
    """Multi-valued cell → array."""
    return F.split(col(column), f"[{separator}]")


def join_cell(column: str | Column, separator: str = CELL_SEPARATOR) -> Column:
    """Array → multi-valued cell: values sorted, duplicates kept."""
    return F.array_join(F.array_sort(col(column)), separator)


def is_lead_author(author: str | Column, key: str | Column) -> Column:
    """The last space-separated part of the name occurs in the record key."""
    return F.contains(col(key), F.element_at(F.split(col(author), " "), -1))


def iri_segment(column: str | Column) -> Column:
    """Replace every ASCII punctuation mark and space by an underscore."""
    return F.regexp_replace(col(column).cast("string"), _IRI_UNSAFE, "_")


def mint_iri(column: str | Column, namespace: str, sanitize: bool = True) -> Column:
    segment = iri_segment(column) if sanitize else col(column).cast("string")
    return F.concat(F.lit(namespace), segment)


def literal(column: str | Column, null_literal: str | None = None) -> Column:
    """Text of a value; a missing value stays null unless a text is given for it."""
    text = col(column).cast("string")
    return F.coalesce(text, F.lit(null_literal)) if null_literal is not None else text


def class_iri(
    column: str | Column,
    namespace: str,
    classes: list[str],
    renamed: dict[str, str] | None = None,
) -> Column:
    """Type value → class IRI; values not listed give null (no triple)."""
    value = col(column)
    for old, new in (renamed or {}).items():
        value = F.when(value == old, F.lit(new)).otherwise(value)
    return F.when(value.isin(classes), F.concat(F.lit(namespace), value))
