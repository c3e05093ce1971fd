"""Transforms of column dependencies: a value's image, the column expression, a predicate's image."""

from __future__ import annotations

import re
from decimal import Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Operators whose predicate on the source holds for the image with the bound moved to the inside.
_UNARY = ("is_null", "not_null")


def murmur3(data: bytes) -> int:
    """32-bit murmur3 with seed 0, as a signed number."""
    mask, h = 0xFFFFFFFF, 0
    turn = lambda x, n: (x << n | x >> 32 - n) & mask
    whole = len(data) & ~3
    for i in range(0, whole, 4):
        k = turn(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (turn(h ^ k, 13) * 5 + 0xE6546B64) & mask
    if tail := data[whole:]:
        h ^= turn(int.from_bytes(tail, "little") * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def murmur3_batch(values: list[bytes]) -> np.ndarray:
    """murmur3 of many values at once: step i takes the i-th word of all that have one; as unsigned numbers in 64 bits."""
    size = np.array([len(v) for v in values], np.int64)
    out = np.zeros(len(values), np.int64)
    by_size = np.argsort(size, kind="stable")
    for at in np.array_split(by_size, max(1, len(values) // 1024)):  # values of like size share a matrix
        if not len(at):
            continue
        n = size[at]
        words = int(n.max()) // 4 + 1
        raw = np.frombuffer(b"".join(values[i].ljust(4 * words, b"\0") for i in at), "<u4").reshape(len(at), words)
        h = np.zeros(len(at), np.uint32)
        turn = lambda x, k: (x << np.uint32(k)) | (x >> np.uint32(32 - k))
        for i in range(words):
            k = turn(raw[:, i] * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
            whole, tail = n >= 4 * i + 4, (n > 4 * i) & (n < 4 * i + 4)
            h = np.where(whole, turn(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64), np.where(tail, h ^ k, h))
        h ^= n.astype(np.uint32)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        out[at] = h ^ (h >> np.uint32(16))
    return out


def bytes_of(value: Any, kind: T.DataType) -> bytes:
    """What is hashed for a bucket: text, bytes, the shortest big-endian unscaled decimal, else a little-endian long."""
    if isinstance(kind, T.StringType):
        return value.encode()
    if isinstance(kind, T.BinaryType):
        return bytes(value)
    if isinstance(kind, T.DecimalType):
        unscaled = int(Decimal(value).scaleb(kind.scale))
        return unscaled.to_bytes((unscaled + (unscaled < 0)).bit_length() // 8 + 1, "big", signed=True)
    return int(value).to_bytes(8, "little", signed=True)


def hashed(value: Any, kind: T.DataType) -> int:
    return murmur3(bytes_of(value, kind))


class Transform:
    """A named function of one column; monotone unless it is a bucket."""

    def __init__(self, text: str, source: T.DataType):
        m = re.fullmatch(r"\s*(\w+)(?:\[(\d+)\])?\s*", text)
        self.text, self.source = text.strip(), source
        self.name, self.width = (m[1].lower(), int(m[2]) if m[2] else None) if m else ("", None)
        time = isinstance(source, (T.TimestampType, T.TimestampNTZType))
        fits = {
            "identity": self.width is None,
            "truncate": bool(self.width) and isinstance(source, (T.StringType, T.IntegralType, T.DecimalType)),
            "bucket": bool(self.width) and isinstance(source, (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)),
            "year": self.width is None and (time or isinstance(source, T.DateType)),
            "month": self.width is None and (time or isinstance(source, T.DateType)),
            "day": self.width is None and (time or isinstance(source, T.DateType)),
            "hour": self.width is None and time,
        }
        if not fits.get(self.name, False):
            raise ValueError(f"transform {text.strip()!r} does not apply to {source.simpleString()}")

    @property
    def result(self) -> T.DataType:
        return self.source if self.name in ("identity", "truncate") else T.IntegerType()

    def value(self, v: Any) -> Any:
        """The image of a comparable value."""
        if v is None or self.name == "identity":
            return v
        if self.name == "truncate":
            if isinstance(v, str):
                return v[: self.width]
            if isinstance(v, Decimal):
                unit = Decimal(1).scaleb(-self.source.scale)
                n = int(v / unit)
                return (n - n % self.width) * unit
            return v - v % self.width
        if self.name == "bucket":
            return (hashed(v, self.source) & 0x7FFFFFFF) % self.width
        days = v if isinstance(self.source, T.DateType) else v // 86_400_000_000
        if self.name == "hour":
            return v // 3_600_000_000
        if self.name == "day":
            return days
        import datetime as dt

        d = dt.date(1970, 1, 1) + dt.timedelta(days)
        return d.year - 1970 if self.name == "year" else (d.year - 1970) * 12 + d.month - 1

    def column(self, c: Column) -> Column:
        """The image of a column, by built-in functions but for buckets of texts, bytes and decimals."""
        if self.name == "identity":
            return c
        if self.name == "truncate":
            if isinstance(self.source, T.StringType):
                return F.substring(c, 1, self.width)
            if isinstance(self.source, T.DecimalType):
                unit = Decimal(1).scaleb(-self.source.scale) * self.width
                return (c - F.pmod(c, F.lit(unit))).cast(self.source)
            return (c - F.pmod(c, F.lit(self.width))).cast(self.source)
        if self.name == "bucket":
            return self.bucket(c)
        if self.name == "year":
            return F.year(c) - 1970
        if self.name == "month":
            return (F.year(c) - 1970) * 12 + F.month(c) - 1
        if self.name == "day":
            return F.datediff(c, F.lit("1970-01-01").cast("date"))
        return F.floor(F.unix_seconds(c.cast("timestamp")) / 3600).cast("int")

    def bucket(self, c: Column) -> Column:
        """Whole numbers and times by the host's own murmur3; its hash of bytes is another one, so these go by batches."""
        kind, width = self.source, self.width
        if not isinstance(kind, (T.StringType, T.BinaryType, T.DecimalType)):
            plain = F.unix_date(c) if isinstance(kind, T.DateType) else F.unix_micros(c.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else c
            jvm = SparkSession.active()._jvm
            columns, expressions = jvm.org.apache.spark.sql.classic.ExpressionUtils, jvm.org.apache.spark.sql.catalyst.expressions
            one = jvm.scala.jdk.javaapi.CollectionConverters.asScala([columns.expression(plain.cast("long")._jc)]).toSeq()
            h = Column(columns.column(expressions.Murmur3Hash(one, 0)))
            return F.when(c.isNotNull(), F.pmod(h.bitwiseAND(0x7FFFFFFF), F.lit(width)).cast("int"))

        @F.pandas_udf("int")
        def of_bytes(s: pd.Series) -> pd.Series:
            known = s.notna().to_numpy()
            out = (murmur3_batch([bytes_of(v, kind) for v in s[known]]) & 0x7FFFFFFF) % width
            full = np.zeros(len(s), np.int64)
            full[known] = out
            return pd.Series(full, dtype="Int32").mask(~known)

        return of_bytes(c)

    def _step(self, v: Any) -> Any:
        return Decimal(1).scaleb(-self.source.scale) if isinstance(v, Decimal) else 1

    def project(self, op: str, v: Any) -> tuple[str, Any] | None:
        """What holds for the image wherever `source op v` holds; None if nothing is known."""
        if op in _UNARY:
            return (op, None) if self.name != "bucket" else None
        if self.name == "identity":
            return op, v
        if op in ("eq", "nseq"):
            return op, self.value(v)
        if op == "in":
            return op, tuple(self.value(x) for x in v)
        if self.name == "bucket" or op not in ("lt", "le", "gt", "ge"):
            return None
        whole = not isinstance(v, (str, float))
        if op == "lt":
            return "le", self.value(v - self._step(v) if whole else v)
        if op == "gt":
            return "ge", self.value(v + self._step(v) if whole else v)
        return op, self.value(v)

    def project_strict(self, op: str, v: Any) -> tuple[str, Any] | None:
        """What on the image implies `source op v`; None if nothing does."""
        if self.name == "identity":
            return op, v
        if op == "ne":
            return "ne", self.value(v)
        if self.name == "bucket" or op not in ("lt", "le", "gt", "ge") or isinstance(v, (str, float)):
            return None
        edge = {"lt": v, "le": v + self._step(v), "gt": v, "ge": v - self._step(v)}[op]
        return ("lt" if op in ("lt", "le") else "gt"), self.value(edge)
