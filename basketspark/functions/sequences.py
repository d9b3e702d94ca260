"""Sequences: typed arrays from delimited text, fixed lengths, and the split into history and target."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ELEMENTS = {"int": "int", "double": "double", "float": "float", "bool": "boolean"}


def parse_sequence(column: Column | str, pattern: str = r"\s+", kind: str = "int") -> Column:
    """A delimited text as a typed array; null and blank texts give an empty array, parts that don't fit the type null."""
    if kind not in ELEMENTS:
        raise ValueError(f"unsupported element type {kind!r}")
    text = F.trim(F.col(column) if isinstance(column, str) else column)
    empty = F.array().cast(f"array<{ELEMENTS[kind]}>")
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(F.split(text, pattern).try_cast(f"array<{ELEMENTS[kind]}>"))


def pad_sequence(column: Column | str, length: int, kind: str = "int") -> tuple[Column, Column]:
    """(the first ``length`` elements, zeros after them; how many there are)."""
    array = F.col(column) if isinstance(column, str) else column
    kept = F.slice(array, 1, length)
    zeros = F.array_repeat(F.lit(0).cast(ELEMENTS[kind]), F.greatest(F.lit(0), F.lit(length) - F.size(kept)))
    return F.concat(kept, zeros), F.size(kept)


def pad_text(column: Column | str, length: int, kind: str = "int") -> tuple[Column, Column]:
    """The same as a text, whose zeros are written at once."""
    kept = F.slice(F.col(column) if isinstance(column, str) else column, 1, length)
    zero = " 0.0" if kind in ("double", "float") else " false" if kind == "bool" else " 0"
    return F.ltrim(F.concat(joined(kept), F.repeat(F.lit(zero), F.lit(length) - F.size(kept)))), F.size(kept)


def decode_baskets(column: Column | str, kind: str = "int") -> Column:
    """``a_b c`` as an array of arrays."""
    text = F.trim(F.col(column) if isinstance(column, str) else column)
    empty = F.array().cast(f"array<array<{ELEMENTS[kind]}>>")
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(F.transform(F.split(text, r"\s+"), lambda b: F.transform(F.split(b, "_"), lambda x: x.try_cast(ELEMENTS[kind]))))


def history_of(baskets: Column) -> Column:
    """All but the last step; a single step is history."""
    return F.slice(baskets, 1, F.greatest(F.size(baskets) - 1, F.least(F.size(baskets), F.lit(1))))


def target_of(baskets: Column) -> Column:
    """The last step; nothing if there is but one."""
    return F.when(F.size(baskets) > 1, F.element_at(baskets, -1))


def joined(array: Column | str, by: str = " ") -> Column:
    return F.array_join((F.col(array) if isinstance(array, str) else array).cast("array<string>"), by)
