"""Frames over managed tables that choose their files anew whenever a filter is added."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column
from pyspark.sql.classic.dataframe import DataFrame

from . import catalyst
from .predicates import FALSE, TRUE, Node


class Choice:
    """The files of some tables, each at a fixed snapshot, that a query needs.

    show(name, frame) makes a table's rows the ones that build() reads. A query is built over one
    file of each table without running, its leaves say which rows they need, and it is built again
    over the files that can hold such rows, so that only those are listed.
    """

    def __init__(self, tables: dict[str, Any], snapshots: dict[str, Any], show: Callable[[str, DataFrame], None]):
        self.tables, self.snapshots, self.show = tables, snapshots, show
        self.plans: dict[str, tuple[int, int, Node]] = {}

    def leaves(self, build: Callable[[], DataFrame], execution: Callable[[], Any] | None) -> list | None:
        for name, t in self.tables.items():
            self.show(name, t.read_files(t.probe(self.snapshots[name])))
        spark = next(iter(self.tables.values())).spark
        try:
            found = catalyst.leaf_filters(spark, execution() if execution else build()._jdf.queryExecution())
        except Exception:  # a plan that fails or has no JSON is read in full, and Spark says what is wrong
            return None
        return None if found is None or any(kind == "InMemoryRelation" for kind, _, _ in found) else found

    def over(self, build: Callable[[], DataFrame], execution: Callable[[], Any] | None = None) -> DataFrame:
        """build() over the files that can matter; execution: its plan where building would run a command."""
        leaves = self.leaves(build, execution)
        self.plans.clear()
        for name, t in self.tables.items():
            at = self.snapshots[name]
            if leaves is None:
                self.show(name, t.read_files(t.entries(at)))
                continue
            predicate: Node = FALSE  # without a leaf nothing is read
            for _, roots, p in leaves:
                if roots and roots[0].startswith(f"{t.root}/data/"):
                    predicate = predicate | (TRUE if p is None else p)
            chosen = t.prune(predicate, at)
            self.plans[name] = (len(chosen.files), chosen.total, chosen.predicate)
            self.show(name, t.read_files(chosen.files))
        return build()


class ManagedFrame(DataFrame):
    """A DataFrame whose later filters prune files too. Other steps are kept, to be built again over fewer files."""

    def __new__(cls, df: DataFrame, choice: Choice, build: Callable[[], DataFrame]) -> ManagedFrame:
        return object.__new__(cls)

    def __init__(self, df: DataFrame, choice: Choice, build: Callable[[], DataFrame]):
        super().__init__(df._jdf, df.sparkSession)
        self.choice, self.build = choice, build

    def filter(self, condition: Column | str) -> DataFrame:
        plain = DataFrame.filter(self, condition)
        build = lambda: self.build().filter(condition)
        try:
            return ManagedFrame(self.choice.over(build), self.choice, build)
        except AnalysisException:  # the condition names a column of this very frame, which a new one has not
            return plain

    where = filter


def _kept(name: str) -> Callable:
    def step(self: ManagedFrame, *args: Any, **more: Any) -> DataFrame:
        done = getattr(DataFrame, name)(self, *args, **more)
        return ManagedFrame(done, self.choice, lambda: getattr(self.build(), name)(*args, **more))

    step.__name__, step.__doc__ = name, getattr(DataFrame, name).__doc__
    return step


for _name in ("select", "selectExpr", "withColumn", "withColumns", "withColumnRenamed", "drop", "alias", "toDF", "distinct", "dropDuplicates", "orderBy", "sort", "join", "union", "unionByName"):
    setattr(ManagedFrame, _name, _kept(_name))
