"""Column types of managed tables: names, field ids, and plain comparable values."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from typing import Any

from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)


class UnsupportedTypeError(TypeError):
    pass


_PLAIN = {T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.StringType: "string", T.DateType: "date", T.TimestampType: "timestamptz", T.TimestampNTZType: "timestamp", T.BinaryType: "binary"}


def storage_type(kind: T.DataType) -> Any:
    """The storage name of an atomic type, or a nested description; raises for what cannot be stored."""
    if isinstance(kind, (T.CharType, T.VarcharType)):
        return "string"
    if isinstance(kind, T.DecimalType):
        return f"decimal({kind.precision},{kind.scale})"
    if isinstance(kind, T.ArrayType):
        return {"list": storage_type(kind.elementType), "optional": kind.containsNull}
    if isinstance(kind, T.MapType):
        return {"key": storage_type(kind.keyType), "value": storage_type(kind.valueType), "optional": kind.valueContainsNull}
    if isinstance(kind, T.StructType):
        return {"struct": {f.name: [storage_type(f.dataType), f.nullable] for f in kind.fields}}
    if type(kind) in _PLAIN:
        return _PLAIN[type(kind)]
    raise UnsupportedTypeError(f"type {kind.simpleString()} cannot be stored in a managed table")


def field_ids(schema: T.StructType) -> dict[str, int]:
    """Ids by dotted path from one counter: a field before its children, a map's key and value before what they hold."""
    out: dict[str, int] = {}

    def give(path: str) -> None:
        out[path] = len(out)

    def into(path: str, kind: T.DataType) -> None:
        storage_type(kind)
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                give(f"{path}.{f.name}".lstrip("."))
                into(f"{path}.{f.name}".lstrip("."), f.dataType)
        elif isinstance(kind, T.MapType):
            give(f"{path}.key")
            give(f"{path}.value")
            into(f"{path}.key", kind.keyType)
            into(f"{path}.value", kind.valueType)
        elif isinstance(kind, T.ArrayType):
            give(f"{path}.element")
            into(f"{path}.element", kind.elementType)

    into("", schema)
    return out


def comparable(value: Any, kind: T.DataType) -> Any:
    """A value as plain Python that orders like Spark's: days for dates, microseconds for times; None if it has no order here."""
    if value is None:
        return None
    if isinstance(kind, T.DateType):
        return value if isinstance(value, int) else (value - EPOCH.date()).days
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(value, int):
            return value
        plain = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
        return (plain - EPOCH) // dt.timedelta(microseconds=1)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return None if math.isnan(value) else float(value)
    if isinstance(kind, T.DecimalType):
        return Decimal(value)
    if isinstance(kind, T.BooleanType):
        return bool(value)
    if isinstance(kind, T.IntegralType):
        return int(value)
    if isinstance(kind, T.StringType):
        return value.decode() if isinstance(value, bytes) else str(value)
    return None


def parsed(text: str, kind: T.DataType) -> Any:
    """The comparable value of a partition directory's or a plan literal's text."""
    if isinstance(kind, T.DateType) and "-" in text[1:]:
        return comparable(dt.date.fromisoformat(text), kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and "-" in text[1:]:
        return comparable(dt.datetime.fromisoformat(text), kind)
    if isinstance(kind, T.BooleanType):
        return text.lower() == "true"
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return comparable(float(text.replace("Infinity", "inf")), kind)
    return Decimal(text) if isinstance(kind, T.DecimalType) else int(text)


def partition_value(text: str, kind: T.DataType) -> Any:
    """As parsed, but NaN is a value of its own: files of a NaN partition hold no nulls."""
    nan = isinstance(kind, (T.FloatType, T.DoubleType)) and text.lower() == "nan"
    return math.nan if nan else parsed(text, kind)


def to_json(value: Any) -> Any:
    return {"d": str(value)} if isinstance(value, Decimal) else {"f": repr(value)} if isinstance(value, float) else value


def from_json(value: Any) -> Any:
    if isinstance(value, dict):
        return Decimal(value["d"]) if "d" in value else float(value["f"])
    return value
