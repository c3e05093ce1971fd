"""Predicates that can prune files, as small immutable trees, and their inclusive evaluation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from tidemark.functions.transforms import Transform


class Node:
    def __and__(self, other: Node) -> Node:
        return FALSE if FALSE in (self, other) else other if self is TRUE else self if other is TRUE else And(self, other)

    def __or__(self, other: Node) -> Node:
        return TRUE if TRUE in (self, other) else other if self is FALSE else self if other is FALSE else Or(self, other)


@dataclass(frozen=True)
class Constant(Node):
    value: bool


TRUE, FALSE = Constant(True), Constant(False)


@dataclass(frozen=True)
class Pred(Node):
    """op: lt le gt ge eq ne in not_in is_null not_null nseq not_nseq starts not_starts."""

    op: str
    column: str
    value: Any = None

    def __str__(self) -> str:
        return f"{self.column} {self.op} {self.value!r}" if self.value is not None else f"{self.column} {self.op}"


@dataclass(frozen=True)
class Not(Node):
    child: Node


@dataclass(frozen=True)
class And(Node):
    left: Node
    right: Node

    def __str__(self) -> str:
        return f"({self.left} and {self.right})"


@dataclass(frozen=True)
class Or(Node):
    left: Node
    right: Node

    def __str__(self) -> str:
        return f"({self.left} or {self.right})"


_PAIRS = [("lt", "ge"), ("le", "gt"), ("eq", "ne"), ("in", "not_in"), ("is_null", "not_null"), ("nseq", "not_nseq"), ("starts", "not_starts")]
OPPOSITE = dict(_PAIRS) | {b: a for a, b in _PAIRS}


def negated(p: Node) -> Node:
    if isinstance(p, Constant):
        return FALSE if p.value else TRUE
    if isinstance(p, Not):
        return pushed(p.child)
    if isinstance(p, And):
        return negated(p.left) | negated(p.right)
    if isinstance(p, Or):
        return negated(p.left) & negated(p.right)
    return Pred(OPPOSITE[p.op], p.column, p.value)


def pushed(p: Node) -> Node:
    """Without NOT: it is taken to the leaves."""
    if isinstance(p, Not):
        return negated(p.child)
    if isinstance(p, And):
        return pushed(p.left) & pushed(p.right)
    if isinstance(p, Or):
        return pushed(p.left) | pushed(p.right)
    return p


@dataclass(frozen=True)
class Dependency:
    """Column dest holds transform(src)."""

    src: str
    dest: str
    transform: Transform


def expanded(p: Node, dependencies: list[Dependency]) -> Node:
    """Every predicate on a source, and what follows for its dependents; one step, not their dependents."""
    if isinstance(p, (And, Or)):
        a, b = expanded(p.left, dependencies), expanded(p.right, dependencies)
        return a & b if isinstance(p, And) else a | b
    if isinstance(p, Pred):
        out: Node = p
        for d in dependencies:
            if d.src == p.column and (q := d.transform.project(p.op, p.value)):
                out = out & Pred(q[0], d.dest, q[1])
        return out
    return p


def _ordered(x: Any) -> Any:
    """Floats in Spark's order: NaN equals itself and exceeds all others."""
    return (x != x, 0.0 if x != x else x) if isinstance(x, float) else (False, x)


def _holds(op: str, x: Any, v: Any) -> bool | None:
    """The predicate on a single known value; None for unknown (null)."""
    if op in ("is_null", "not_null"):
        return (x is None) == (op == "is_null")
    if op in ("starts", "not_starts"):
        return None if x is None else x.startswith(v) == (op == "starts")
    known = x is not None
    x, v = _ordered(x), [_ordered(y) for y in v] if op in ("in", "not_in") else _ordered(v)
    if op in ("nseq", "not_nseq"):
        return (x == v) == (op == "nseq")
    if not known:
        return None
    return {"lt": lambda: x < v, "le": lambda: x <= v, "gt": lambda: x > v, "ge": lambda: x >= v, "eq": lambda: x == v, "ne": lambda: x != v, "in": lambda: x in v, "not_in": lambda: x not in v}[op]()


@dataclass(frozen=True)
class Stats:
    rows: int
    nulls: int | None
    lower: Any
    upper: Any


def _may(op: str, s: Stats, v: Any) -> bool:
    """Whether a file with these statistics may hold a row for which the predicate is true."""
    if op == "is_null":
        return s.nulls is None or s.nulls > 0
    if op == "not_null":
        return s.nulls is None or s.nulls < s.rows
    if op == "not_nseq":
        return True
    if op == "nseq" and v is None:
        return s.nulls is None or s.nulls > 0
    if s.nulls is not None and s.nulls == s.rows:
        return False
    lo, hi = s.lower, s.upper
    if op == "lt":
        return lo is None or lo < v
    if op == "le":
        return lo is None or lo <= v
    if op == "gt":
        return hi is None or hi > v
    if op == "ge":
        return hi is None or hi >= v
    if op in ("eq", "nseq"):
        return (lo is None or lo <= v) and (hi is None or hi >= v)
    if op == "in":
        return any(_may("eq", s, x) for x in v if x is not None)
    if op == "starts":
        return (lo is None or lo[: len(v)] <= v) and (hi is None or hi[: len(v)] >= v)
    return True


def may_match(p: Node, partition: dict[str, Any], stats: Callable[[str], Stats | None]) -> bool:
    """False only if no row of the file can satisfy p: partition values decide exactly, statistics by their bounds."""
    if isinstance(p, Constant):
        return p.value
    if isinstance(p, And):
        return may_match(p.left, partition, stats) and may_match(p.right, partition, stats)
    if isinstance(p, Or):
        return may_match(p.left, partition, stats) or may_match(p.right, partition, stats)
    if isinstance(p, Not):
        return may_match(negated(p.child), partition, stats)
    if p.column in partition:
        try:
            return _holds(p.op, partition[p.column], p.value) is True
        except TypeError:
            return True
    s = stats(p.column)
    try:
        return s is None or _may(p.op, s, p.value)
    except TypeError:
        return True
