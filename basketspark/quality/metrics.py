"""Column constraints as counting conditions; all of a table's are computed in one aggregate."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .errors import EmptyDatasetError, InvalidConstraintError


class Metric(NamedTuple):
    rule: str
    category: str
    columns: tuple[str, ...]
    failed: Column


def _bounds(column: dict, low: str, high: str, kinds: tuple = (int, float)) -> tuple | None:
    c = column.get("constraints") or {}
    a, b = c.get(low), c.get(high)
    for x in (a, b):
        if x is not None and (isinstance(x, bool) or not isinstance(x, kinds)):
            raise InvalidConstraintError(f"{column['name']}: {low} and {high} must be numbers")
    if a is not None and b is not None and a > b:
        raise InvalidConstraintError(f"{column['name']}: {low} is above {high}")
    return None if a is None and b is None else (a, b)


def _outside(value: Column, bounds: tuple) -> Column:
    low, high = bounds
    tests = [t for t in (None if low is None else value < low, None if high is None else value > high) if t is not None]
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def _lengths(column: dict, low: str, high: str) -> tuple | None:
    bounds = _bounds(column, low, high, (int,))
    if bounds and any(x is not None and x < 0 for x in bounds):
        raise InvalidConstraintError(f"{column['name']}: {low} and {high} can't be negative")
    return bounds


def nullability(column: dict) -> Column | None:
    if column.get("nullable", True) and "nullability" not in (column.get("thresholds") or {}):
        return None
    return F.col(column["name"]).isNull()


def value_range(column: dict) -> Column | None:
    bounds = _bounds(column, "minimum", "maximum")
    return bounds and _outside(F.col(column["name"]), bounds)


def allowed_values(column: dict) -> Column | None:
    allowed = (column.get("constraints") or {}).get("allowed_values")
    if allowed is None:
        return None
    if not isinstance(allowed, list) or not allowed:
        raise InvalidConstraintError(f"{column['name']}: allowed_values must be a list with values")
    text = column["type"] in ("string", "str")
    if any(isinstance(v, str) != text for v in allowed):
        raise InvalidConstraintError(f"{column['name']}: allowed_values of another type")
    return ~F.col(column["name"]).isin(allowed)


def string_length(column: dict) -> Column | None:
    bounds = _lengths(column, "minimum_length", "maximum_length")
    return bounds and _outside(F.length(column["name"]), bounds)


def pattern(column: dict) -> Column | None:
    text = (column.get("constraints") or {}).get("pattern")
    if text is None:
        return None
    if not isinstance(text, str) or not text.strip():
        raise InvalidConstraintError(f"{column['name']}: pattern must be a text")
    try:
        re.compile(text)
    except re.error as e:
        raise InvalidConstraintError(f"{column['name']}: {e}") from e
    return ~F.col(column["name"]).rlike(text)


def array_length(column: dict) -> Column | None:
    bounds = _lengths(column, "minimum_items", "maximum_items")
    return bounds and _outside(F.when(F.col(column["name"]).isNotNull(), F.size(column["name"])), bounds)


CATEGORIES = {"nullability": nullability, "range": value_range, "allowed_values": allowed_values, "string_length": string_length, "pattern": pattern, "array_length": array_length}


def column_metrics(contract: dict) -> list[Metric]:
    """Nulls fail nullability alone: every other condition is null for them, which doesn't count."""
    found = ((c, kind, test(c)) for c in contract["schema"] for kind, test in CATEGORIES.items())
    return [Metric(f"{c['name']}_{kind}", kind, (c["name"],), failed) for c, kind, failed in found if failed is not None]


def counting(metrics: list[Metric]) -> list[Column]:
    """``total`` and a count of failures for each metric, named by its rule."""
    return [F.count("*").alias("total"), *(F.count_if(m.failed).alias(m.rule) for m in metrics)]


def counted(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """One row of these counts."""
    return df.agg(*counting(metrics))


def counts(df: DataFrame, metrics: list[Metric], dataset: str = "") -> dict[str, int]:
    row = counted(df, metrics).first().asDict()
    if not row["total"]:
        raise EmptyDatasetError(f"dataset {dataset} has no rows")
    return row
