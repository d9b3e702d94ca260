"""Contract types: one table for building schemas and for checking them."""

from __future__ import annotations

from pyspark.sql import types as T

from ..quality.errors import InvalidContractError

#: Contract type: (type to build, types accepted when checking).
TYPES = {
    "integer": (T.IntegerType(), (T.ByteType, T.ShortType, T.IntegerType, T.LongType)),
    "long": (T.LongType(), (T.ByteType, T.ShortType, T.IntegerType, T.LongType)),
    "float": (T.FloatType(), (T.FloatType,)),
    "double": (T.DoubleType(), (T.FloatType, T.DoubleType)),
    "number": (T.DoubleType(), (T.NumericType,)),
    "decimal": (T.DecimalType(38, 18), (T.DecimalType,)),
    "string": (T.StringType(), (T.StringType,)),
    "boolean": (T.BooleanType(), (T.BooleanType,)),
    "date": (T.DateType(), (T.DateType,)),
    "timestamp": (T.TimestampType(), (T.TimestampType,)),
}
TYPES |= {"int": TYPES["integer"], "str": TYPES["string"], "bool": TYPES["boolean"]}


def normal(kind: str) -> str:
    """The type's name in lower case without blanks around it."""
    if not isinstance(kind, str):
        raise InvalidContractError(f"a type must be a text, not {kind!r}")
    return kind.strip().lower()


def element_type(kind: str) -> str | None:
    """The element's type of ``array<...>``, None for other types."""
    kind = normal(kind)
    if not (kind.startswith("array<") and kind.endswith(">")):
        return None
    if not (inner := kind[6:-1].strip()):
        raise InvalidContractError("an array type needs an element type")
    return inner


def data_type(kind: str) -> T.DataType:
    if (inner := element_type(kind)) is not None:
        return T.ArrayType(data_type(inner))
    if (kind := normal(kind)) not in TYPES:
        raise InvalidContractError(f"unknown type {kind!r}")
    return TYPES[kind][0]


def accepts(kind: str, actual: T.DataType) -> bool:
    """Whether a column of the actual type may hold the contract's type."""
    if (inner := element_type(kind)) is not None:
        return isinstance(actual, T.ArrayType) and accepts(inner, actual.elementType)
    if (kind := normal(kind)) not in TYPES:
        raise InvalidContractError(f"unknown type {kind!r}")
    return isinstance(actual, TYPES[kind][1])


def spark_schema(contract: dict) -> T.StructType:
    return T.StructType([T.StructField(c["name"], data_type(c["type"]), c.get("nullable", True)) for c in contract["schema"]])
