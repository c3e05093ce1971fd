"""Approximate nearest neighbours by stable projections, kd-trees and a chi-square test.

Vectors are projected to DIMENSIONS by Gaussian (2-stable) directions: the squared projected
distance over the squared distance is chi-square distributed. A search takes projected neighbours
in the order of their projected distance and verifies them on the original vectors; it stops once a
vector nearer than the k-th found would, with probability SURE, have had a smaller projected
distance than the next. A true neighbour is thus missed with probability 1 - SURE at most.

The index is one kd-tree over the projections. Its upper part is cut from a bounded sample and
deals all vectors to cells; the lower parts are built where a cell is searched. A query first
searches its own cell, which bounds the distance of its k-th neighbour; then it goes to the cells
whose bounding box the test leaves, and to no others. Queries of one cell travel together, so a
cell is copied once for each block of queries that needs it. How much is verified depends on the
data: next to all vectors being equally far, no projection can leave many out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import Scratch, broadcast_if, partitions, ranked

DIMENSIONS, LEAF, SURE = 16, 64, 0.95
#: Vectors of a block of a cell and of a block of queries (a task holds one of each), vectors that are verified at once.
CELL, QUERY_BLOCK, CHUNK = 8192, 2048, 128
#: Vectors (about) that cut the upper tree, and its most cells; fuller cells are dealt to blocks, all of which are searched.
SAMPLE, MOST_CELLS, MOST_TASKS = 1 << 16, 4096, 1 << 15


def chi_square(x: float, m: int) -> float:
    """The distribution function for an even number of degrees."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total if x < 1400 else 1.0


def quantile(p: float, m: int) -> float:
    lo, hi = 0.0, 1400.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, m) < p else (lo, mid)
    return hi


def directions(dims: int) -> np.ndarray:
    return np.random.default_rng(20140901 + dims).standard_normal((dims, DIMENSIONS))


def nearest_of_box(lo: np.ndarray, hi: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared least distance of a point from each box."""
    return (np.maximum(np.maximum(lo - p, p - hi), 0) ** 2).sum(1)


class Splits:
    """The upper kd-tree: cuts of sampled points along their widest axis, and a number for each cell."""

    def __init__(self, points: np.ndarray, cells: int):
        self.axis, self.cut, self.low, self.high, self.cells = [], [], [], [], 0
        self.root = self.grow(points, cells)
        self.inner = [np.array(x) for x in (self.axis, self.cut, self.low, self.high)]

    def grow(self, p: np.ndarray, cells: int) -> int:
        """The place of a cut, or -1 - cell."""
        if cells > 1 and len(p) > 1:
            axis = int((p.max(0) - p.min(0)).argmax())
            cut = np.sort(p[:, axis])[len(p) * (cells // 2) // cells]
            below = p[:, axis] < cut
            if below.any():
                at = len(self.axis)
                for own, x in ((self.axis, axis), (self.cut, float(cut)), (self.low, 0), (self.high, 0)):
                    own.append(x)
                self.low[at] = self.grow(p[below], cells // 2)
                self.high[at] = self.grow(p[~below], cells - cells // 2)
                return at
        self.cells += 1
        return -self.cells

    def of(self, p: np.ndarray) -> np.ndarray:
        at = np.full(len(p), self.root)
        while (i := np.flatnonzero(at >= 0)).size:
            axis, cut, low, high = (x[at[i]] for x in self.inner)
            at[i] = np.where(p[i, axis] < cut, low, high)
        return -1 - at


class Tree:
    """A cell's lower kd-tree: leaves of at most LEAF projected points, with their bounding boxes."""

    def __init__(self, points: np.ndarray):
        self.points, self.rows = points, []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            p = points[rows]
            wide = np.ptp(p, axis=0)
            if len(rows) > LEAF and wide.max() > 0:
                order = rows[np.argsort(p[:, int(wide.argmax())], kind="stable")]
                todo += [order[: len(order) // 2], order[len(order) // 2 :]]
            else:
                self.rows.append(rows)
        self.lo, self.hi = (np.stack([f(points[r], axis=0) for r in self.rows]) for f in (np.min, np.max))

    def nearest(self, p: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks of (squared projected distances, rows), nearest first."""
        bounds = nearest_of_box(self.lo, self.hi, p)
        order = np.argsort(bounds, kind="stable")
        r2, rows, at, step = np.zeros(0), np.zeros(0, np.int64), 0, 2
        while at < len(order) or len(rows):
            opened = np.concatenate([self.rows[i] for i in order[at : at + step]]) if at < len(order) else np.zeros(0, np.int64)
            at, step = at + step, 2 * step
            r2 = np.concatenate([r2, ((self.points[opened] - p) ** 2).sum(1)])
            rows = np.concatenate([rows, opened])
            by = np.argsort(r2, kind="stable")
            r2, rows = r2[by], rows[by]
            ready = np.searchsorted(r2, bounds[order[at]], "right") if at < len(order) else len(r2)
            for i in range(0, ready, CHUNK):
                yield r2[i : min(i + CHUNK, ready)], rows[i : min(i + CHUNK, ready)]
            r2, rows = r2[ready:], rows[ready:]


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, limits: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(row of the query, ids, distances, vectors verified) for each query; ties to smaller ids.

    limits: a distance for each query within which it knows k vectors already.
    """
    plane, stop = directions(x.shape[1]), quantile(SURE, DIMENSIONS)
    tree, projected = Tree(x @ plane), queries @ plane
    for row, (qid, q, p) in enumerate(zip(query_ids, queries, projected)):
        best_d, best_i, verified, slack = np.zeros(0), np.zeros(0, np.int64), 0, 1e-18 * float(p @ p)
        known = np.inf if limits is None else limits[row]
        for r2, rows in tree.nearest(p):
            far = stop * min(known, best_d[k - 1] if len(best_d) == k else np.inf) ** 2 + slack
            if r2[0] > far:
                break
            rows = rows[(r2 <= far) & (ids[rows] != qid)]
            verified += len(rows)
            d = np.sqrt(((x[rows] - q) ** 2).sum(1))
            d, i = np.concatenate([best_d, d]), np.concatenate([best_i, ids[rows]])
            order = np.lexsort((i, d))[:k]
            best_d, best_i = d[order], i[order]
        yield row, best_i, best_d, verified


def usable(vectors: Column) -> Column:
    """Not null or empty, all components finite, not all of them zero."""
    ok = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(vectors, lambda x: x != 0), F.lit(False))


def searched(tasks: DataFrame, count: int, k: int) -> DataFrame:
    """(query_id, vec_id, score, verified) of tasks (task, query boolean, id, v, limit): each task's vectors before its queries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = pd.concat(held)
            data, queries = own[~own["query"]], own[own["query"]]
            if len(data) and len(queries):
                x, q = np.stack(data["v"]), np.stack(queries["v"])
                qids = queries["id"].to_numpy(np.int64)
                got = search(data["id"].to_numpy(np.int64), x, qids, q, k, queries["limit"].to_numpy(np.float64))
                yield from (pd.DataFrame({"query_id": qids[row], "vec_id": i, "score": d, "verified": n}) for row, i, d, n in got if len(i))

        now, held = None, []
        for batch in batches:
            for task, part in batch.groupby("task", sort=True):
                if task != now and held:
                    yield from found(held)
                    held = []
                now = task
                held.append(part)
        if held:
            yield from found(held)

    dealt = tasks.repartitionById(count, (F.col("task") % count).cast("int")).sortWithinPartitions("task", "query")
    return dealt.mapInPandas(run, "query_id long, vec_id long, score double, verified long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row whose vec_id is divisible by every.

    score is the Euclidean distance of the original vectors in double precision; ties go to the
    smaller vec_id; a query with fewer candidates returns all. Rows whose vec_id is null or whose
    vector is null, empty, zero or holds a null or a non-finite component take no part. Vectors
    meet only those of their own length. Rows that repeat a query's id are no candidates of it;
    if the id of a query repeats, its results are the nearest found over its rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter(usable(F.col("v")) & F.col("vec_id").isNotNull())
    sizes = {r["dim"]: r["count"] for r in rows.groupBy(F.size("v").alias("dim")).count().collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = F.pmod(F.xxhash64(F.lit(3), "vec_id", "v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / sum(sizes.values())) * (1 << 30))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"dim": [len(v) for v in batch["v"]], "p": [(np.asarray(v) @ directions(len(v))).tolist() for v in batch["v"]]})

    sample: dict[int, list] = {}
    if max(sizes.values()) > CELL:
        for r in rows.filter(share).select("v").mapInPandas(project, "dim int, p array<double>").collect():
            sample.setdefault(r["dim"], []).append(r["p"])
    splits, first, cells = {}, {}, 0
    for dim, n in sorted(sizes.items()):
        points = np.array(sample.get(dim, [])).reshape(-1, DIMENSIONS)
        splits[dim], first[dim] = Splits(points, min(MOST_CELLS, -(-n // CELL))), cells
        cells += splits[dim].cells

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = np.array([len(v) for v in batch["v"]])
            for dim in np.unique(size):
                part = batch[size == dim]
                p = np.stack(part["v"]) @ directions(int(dim))
                cell = first[int(dim)] + splits[int(dim)].of(p)
                yield pd.DataFrame({"id": part["vec_id"], "v": part["v"], "cell": cell, "p": list(p)})

    placed = scratch.table(rows.mapInPandas(place, "id long, v array<double>, cell long, p array<double>"))
    axes = [f(F.col("p")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.sum((F.col("id") % every == 0).cast("long")).alias("queries"), *axes).collect()  # a row a cell
    boxes.sort(key=lambda r: r["cell"])
    number = np.array([r["cell"] for r in boxes])
    lo, hi = (np.array([[r[f"{name}{i}"] for i in range(DIMENSIONS)] for r in boxes]) for name in ("lo", "hi"))
    blocks = np.array([-(-r["n"] // CELL) for r in boxes])
    dims = {c: d for d in sizes for c in range(first[d], first[d] + splits[d].cells)}
    dim_of = np.array([dims[c] for c in number])
    per_cell = spark.createDataFrame([(int(c), int(b), max(1, -(-r["queries"] // QUERY_BLOCK))) for c, b, r in zip(number, blocks, boxes)], "cell long, blocks long, qblocks long")
    block = F.pmod(F.xxhash64(F.lit(1), "id", "v"), "blocks")
    data = placed.join(F.broadcast(per_cell), "cell").select("id", "v", "p", "cell", block.alias("block"), F.pmod(F.xxhash64(F.lit(2), "id"), "qblocks").alias("qblock"))
    queries = data.filter(F.col("id") % every == 0)

    # first the query's own cell, of a full one its first block
    no_limit = F.lit(float("inf")).alias("limit")
    own = data.filter("block = 0").select(F.col("cell").alias("task"), F.lit(False).alias("query"), "id", "v", no_limit)
    own = own.unionByName(queries.select(F.col("cell").alias("task"), F.lit(True).alias("query"), "id", "v", no_limit))
    near = scratch.table(searched(own, min(cells, MOST_TASKS), k))
    limits = best_of(near, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("limit"))

    stop = quantile(SURE, DIMENSIONS)

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, (p, cell, limit) in enumerate(zip(batch["p"], batch["cell"], batch["limit"])):
                near = (nearest_of_box(lo, hi, np.asarray(p)) <= stop * limit * limit * (1 + 1e-9)) & (dim_of == dims[cell])
                out += [(i, c, b) for c, n in zip(number[near], blocks[near]) for b in range(n) if c != cell or b]
            at = [i for i, _, _ in out]
            yield pd.DataFrame({"id": batch["id"].to_numpy()[at], "v": batch["v"].to_numpy()[at], "limit": batch["limit"].to_numpy()[at], "home": batch["cell"].to_numpy()[at], "qblock": batch["qblock"].to_numpy()[at], "cell": [c for _, c, _ in out], "block": [b for _, _, b in out]})

    ask = queries.join(limits, "id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    ask = scratch.table(ask.mapInPandas(wanted, "id long, v array<double>, limit double, home long, qblock long, cell long, block long"))
    keys = ["home", "qblock", "cell", "block"]
    pairs = scratch.table(ranked(scratch, ask.select(*keys).distinct(), keys, "task"))
    if count := pairs.count():
        side = broadcast_if(pairs, F.lit(40))
        rest = data.select("id", "v", "cell", "block").join(side, ["cell", "block"]).select("task", F.lit(False).alias("query"), "id", "v", no_limit)
        rest = rest.unionByName(ask.join(side, keys).select("task", F.lit(True).alias("query"), "id", "v", "limit"))
        near = near.unionByName(searched(rest, max(partitions(spark), min(count, MOST_TASKS)) if count > 1 else 1, k))
    return best_of(near, k).select("query_id", "rank", "vec_id", "score")
