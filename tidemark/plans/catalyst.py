"""Catalyst's optimized plan, as JSON, to predicates on the leaves' columns."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.functions.types import comparable, parsed

from .predicates import FALSE, TRUE, Node, Not, Pred

_COMPARE = {"LessThan": ("lt", "gt"), "LessThanOrEqual": ("le", "ge"), "GreaterThan": ("gt", "lt"), "GreaterThanOrEqual": ("ge", "le"), "EqualTo": ("eq", "eq"), "EqualNullSafe": ("nseq", "nseq")}


class Tree:
    """A node of Catalyst's flat pre-order JSON with its children."""

    def __init__(self, nodes: list[dict], at: list[int]):
        self.data = nodes[at[0]]
        at[0] += 1
        self.name = self.data["class"].rpartition(".")[2]
        self.children = [Tree(nodes, at) for _ in range(self.data["num-children"])]


def _kind(data: Any) -> T.DataType | None:
    try:
        return T._parse_datatype_json_value(data)
    except Exception:  # a type that Python cannot name has no pushable literal
        return None


def _literal(e: Tree) -> tuple[bool, Any]:
    """(whether e is a literal with an order, its value)."""
    if e.name != "Literal":
        return False, None
    if e.data.get("value") is None:
        return True, None
    kind = _kind(e.data["dataType"])
    if kind is None or isinstance(kind, T.BinaryType):
        return False, None
    try:
        value = parsed(str(e.data["value"]), kind)
        value = comparable(value, kind) if not isinstance(value, int) else value
    except (ValueError, ArithmeticError):
        return False, None
    return value is not None, value


def _column(e: Tree) -> str | None:
    return e.data["name"] if e.name == "AttributeReference" else None


def to_predicate(e: Tree, strict: bool) -> Node | None:
    """None: not exactly expressible (strict), or nothing known. Without strict, conjuncts not expressible are true."""
    if e.name == "And":
        a, b = (to_predicate(c, strict) for c in e.children)
        if strict and (a is None or b is None):
            return None
        return (a or TRUE) & (b or TRUE)
    if e.name == "Or":
        a, b = (to_predicate(c, strict) for c in e.children)
        return None if a is None or b is None else a | b
    if e.name == "Not":
        a = to_predicate(e.children[0], True)
        return None if a is None else Not(a)
    if e.name in ("IsNull", "IsNotNull"):
        c = _column(e.children[0])
        return None if c is None else Pred("is_null" if e.name == "IsNull" else "not_null", c)
    if e.name in _COMPARE:
        for (left, right), op in zip((e.children, e.children[::-1]), _COMPARE[e.name]):
            ok, v = _literal(right)
            if (c := _column(left)) is not None and ok:
                if v is None:
                    return Pred("is_null", c) if op == "nseq" else None
                return Pred(op, c, v)
        return None
    if e.name == "In":
        c, values = _column(e.children[0]), [_literal(x) for x in e.children[1:]]
        if c is None or not all(ok and v is not None for ok, v in values):
            return None
        return Pred("in", c, tuple(v for _, v in values))
    if e.name == "StartsWith":
        ok, v = _literal(e.children[1])
        c = _column(e.children[0])
        return Pred("starts", c, v) if c is not None and ok and isinstance(v, str) else None
    if e.name == "Literal" and e.data.get("dataType") == "boolean":
        return TRUE if str(e.data.get("value")).lower() == "true" else FALSE
    if e.name == "AttributeReference" and e.data.get("dataType") == "boolean":
        return Pred("eq", e.data["name"], True)
    return None


def unexecuted(spark: SparkSession, plan: Any) -> Any:
    """The execution of a parsed plan that plans commands without running them."""
    return spark._jsparkSession.sessionState().executePlan(plan, spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP())


def leaf_filters(spark: SparkSession, execution: Any, strict: bool = False) -> list[tuple[str, list[str], Node | None]] | None:
    """(kind, root paths, predicate) of each leaf of the optimized plan and of its subqueries; None if some can't be seen.

    The predicate is of the Filter right above the leaf; None there means no filter, that is true.
    Commands keep queries out of sight.
    """
    key = "spark.sql.optimizer.inSetConversionThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        plan = execution.optimizedPlan()
        inner = plan.subqueriesAll()
        plans = [plan, *(inner.apply(i) for i in range(inner.size()))]
        seen = [(json.loads(p.toJSON()), p.collectLeaves()) for p in plans]
        command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
        if any(command.isInstance(p) for p in plans) or any(n["class"].endswith("Command") for nodes, _ in seen for n in nodes):
            return None
    finally:
        spark.conf.set(key, before)
    return [leaf for nodes, leaves in seen for leaf in _leaves_of(nodes, leaves, strict)]


def _leaves_of(nodes: list[dict], leaves: Any, strict: bool) -> list[tuple[str, list[str], Node | None]]:
    out: list[tuple[str, list[str], Node | None]] = []

    def walk(t: Tree, above: Tree | None) -> None:
        if not t.children:
            found = None
            if above is not None and above.name == "Filter":
                condition = above.data["condition"]
                found = to_predicate(Tree(condition, [0]), strict) if isinstance(condition, list) else None
                found = found if found is not None or strict else TRUE
            leaf, roots = leaves.apply(len(out)), []
            if t.name == "LogicalRelation" and "HadoopFsRelation" in leaf.relation().getClass().getName():
                paths = leaf.relation().location().rootPaths()
                roots = [str(paths.apply(i).toString()) for i in range(paths.size())]
            out.append((t.name, roots, found))
        for c in t.children:
            walk(c, t)

    walk(Tree(nodes, [0]), None)
    return out
