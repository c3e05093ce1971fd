"""Embedding near-duplicates by NN-descent.

A graph of nearest neighbours starts from cells of random hyperplanes and is refined: whoever
shares a neighbour is compared, and each vector keeps its best. Vectors whose whole list is above
the threshold are saturated; their lists are enlarged up to MOST. What is still saturated then may
have links beyond its list, so it is compared exactly with all vectors of its label that an angle
bound does not rule out. Components of the threshold edges meet in blocks, in double precision,
which gives each vector's number of links without a row for each link. Recall is audited on
bounded samples (any, linked, saturated and nearly linked vectors) against all rows, each sample
by itself; below the target the descent goes on with longer lists and fresh cells, and where the
last try misses it all vectors of a label meet in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import usable
from .base import Scratch, components, spread_join
from .minhash import forest

NEIGHBOURS, MOST, TREES, CELL, GROUP = 10, 64, 4, 48, 64
ROUNDS, SETTLED, AUDITED, TARGET, TRIES = 6, 0.002, 256, 0.98, 3
#: Single precision differs from double precision by less.
MARGIN, BLOCK = 1e-4, 512
BITS = 20
#: Blocks of saturated vectors that a task holds against a block of others; radians that rounding may cost.
PROBES, SLACK = 256, 1e-4


def units(nodes: DataFrame, seed: int) -> DataFrame:
    """(node, label, unit, signs): the direction in single precision, BITS hyperplane sides for each tree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for v in batch["v"]:
                v = np.asarray(v, np.float64)
                v = v / np.abs(v).max()
                u = v / np.sqrt((v * v).sum())
                planes = np.random.default_rng([seed, len(u)]).standard_normal((TREES * BITS, len(u))) if len(u) != run.dim else run.planes
                run.dim, run.planes = len(u), planes
                sides = (planes @ u > 0).reshape(TREES, BITS) @ (1 << np.arange(BITS)[::-1])
                out.append((u.astype(np.float32).tobytes(), sides.tolist()))
            yield pd.DataFrame({"node": batch["node"], "label": batch["label"], "unit": [u for u, _ in out], "signs": [s for _, s in out]})

    run.dim, run.planes = -1, None
    return nodes.select("node", "label", "v").mapInPandas(run, "node long, label string, unit binary, signs array<long>")


def cells(unit: DataFrame) -> DataFrame:
    """(g, node): cells of about CELL vectors in each tree; a fuller one is dealt out."""
    size = unit.groupBy("label").agg(F.count("*").alias("n"))
    bits = F.greatest(F.lit(0), F.least(F.lit(BITS), F.ceil(F.log2(F.col("n") / CELL)))).cast("int")
    at = unit.join(size, "label").select("node", "label", bits.alias("bits"), F.posexplode("signs").alias("tree", "signs"))
    at = at.withColumn("cell", F.expr(f"shiftright(signs, {BITS} - bits)"))
    return dealt(at.select(F.xxhash64("label", "tree", "cell").alias("g"), "node"), CELL)


def dealt(members: DataFrame, most: int) -> DataFrame:
    size = members.groupBy("g").agg(F.count("*").alias("n"))
    salt = F.pmod(F.xxhash64("node", "g"), F.ceil(F.col("n") / most).cast("long"))
    return members.join(size, "g").select(F.xxhash64("g", salt).alias("g"), "node")


def local_join(members: DataFrame, unit: DataFrame, worst: DataFrame | None, dims: int) -> DataFrame:
    """(a, b, sim): for every member of a group its nearest in the group that beat its list's last."""
    known = unit.select("node", "unit")
    known = known.join(worst, "node", "left") if worst is not None else known.withColumns({"least": F.lit(-2.0), "k": F.lit(NEIGHBOURS)})
    packed = members.join(known.select("node", "unit", F.coalesce("least", F.lit(-2.0)).cast("float").alias("least"), F.coalesce("k", F.lit(NEIGHBOURS)).alias("k")), "node")
    packed = packed.groupBy("g").agg(F.collect_list(F.struct("node", "unit", "least", "k")).alias("rows")).filter(F.size("rows") > 1).select("rows")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rows in batch["rows"]:
                ids = np.array([r["node"] for r in rows])
                x = np.frombuffer(b"".join(r["unit"] for r in rows), np.float32).reshape(len(rows), dims)
                least, k = np.array([r["least"] for r in rows]), np.array([r["k"] for r in rows])
                s = x @ x.T
                np.fill_diagonal(s, -3)
                m = min(len(rows) - 1, int(k.max()))
                best = np.argpartition(-s, m - 1, axis=1)[:, :m]
                sims = np.take_along_axis(s, best, 1)
                i, j = np.nonzero(sims > least[:, None])
                out.append((ids[i], ids[best[i, j]], sims[i, j]))
            a, b, s = (np.concatenate(x) if x else np.zeros(0) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
            yield pd.DataFrame({"a": a, "b": b, "sim": s})

    return packed.mapInPandas(run, "a long, b long, sim float")


def refined(old: DataFrame | None, found: DataFrame, threshold: float, start: int) -> DataFrame:
    """(a, b, sim, fresh, least, k): lists with the new neighbours; a saturated list is twice as long."""
    both = found.select("a", "b", "sim", F.lit(1).alias("fresh"), F.lit(start).alias("k"))
    if old is not None:
        both = both.unionByName(old.select("a", "b", "sim", F.lit(0).alias("fresh"), "k"))
    once = both.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.max("k").alias("k"))
    lists = once.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("sim", "b", "fresh")), asc=False).alias("l"), F.max("k").alias("k"))
    lists = lists.withColumn("k", F.greatest("k", F.lit(start))).withColumn("l", F.slice("l", 1, F.col("k")))
    last = F.element_at("l", -1)["sim"]
    full = F.size("l") >= F.col("k")
    saturated = full & (last >= threshold - MARGIN)
    least = F.when(saturated & (F.col("k") < MOST), F.lit(-2.0)).when(full, last).otherwise(F.lit(-2.0))
    return lists.select("a", F.explode("l").alias("x"), least.alias("least"), F.when(saturated, F.least(2 * F.col("k"), F.lit(MOST))).otherwise(F.col("k")).alias("k")).select("a", "x.b", "x.sim", "x.fresh", "least", "k")


def full(graph: DataFrame, threshold: float, start: int) -> DataFrame:
    """(node): those whose list may hold only some of their links."""
    lists = graph.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("size"), F.min("sim").alias("last"))
    return lists.filter((F.col("size") >= start) & (F.col("last") >= threshold - MARGIN)).select("node")


def beyond(unit: DataFrame, comps: DataFrame, saturated: DataFrame, threshold: float, dims: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect each saturated vector's component with every other one it has a link to.

    Blocks of a component's saturated vectors have a centre and a radius: by the triangle
    inequality of angles a vector farther from the centre than radius and threshold has no link there.
    """
    reach = math.acos(max(-1.0, threshold - MARGIN)) + SLACK
    nodes = unit.select("node", "label", "unit").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = scratch.table(nodes)
    chosen = nodes.join(saturated, "node", "left_semi")
    size = chosen.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    chosen = chosen.join(size, "root").withColumn("probe", F.xxhash64("root", F.pmod(F.xxhash64(F.lit(11), "node"), "blocks"), "label"))
    member = F.collect_list(F.struct("node", "unit"))
    probes = scratch.table(chosen.groupBy("probe", "root", "label").agg(member.alias("members")))

    def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(x @ y.T, -1, 1))

    def stacked(rows: list, name: str) -> np.ndarray:
        x = np.frombuffer(b"".join(r[name] for r in rows), np.float32).reshape(len(rows), dims).astype(np.float64)
        return x / np.sqrt((x * x).sum(1))[:, None]

    def balls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rows in batch["members"]:
                x = stacked(rows, "unit")
                c = x.sum(0)
                c = c / n if (n := np.sqrt(c @ c)) > 1e-6 else x[0]
                out.append((c.astype(np.float32).tobytes(), float(angles(x, c[None]).max())))
            yield pd.DataFrame({"probe": batch["probe"], "root": batch["root"], "label": batch["label"], "centre": [c for c, _ in out], "radius": [r for _, r in out]})

    def near_balls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, probed in zip(batch["rows"], batch["probes"]):
                far = angles(stacked(rows, "unit"), stacked(probed, "centre")) > np.array([p["radius"] for p in probed]) + reach
                i, j = np.nonzero(~far & (np.array([r["root"] for r in rows])[:, None] != np.array([p["root"] for p in probed])))
                yield pd.DataFrame({"node": np.array([r["node"] for r in rows])[i], "probe": np.array([p["probe"] for p in probed])[j]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for members, rows in zip(batch["members"], batch["rows"]):
                near = stacked(members, "unit") @ stacked(rows, "unit").T >= threshold - MARGIN
                linked = np.flatnonzero(near.any(0))
                once = linked[np.unique(np.array([rows[j]["root"] for j in linked], np.int64), return_index=True)[1]]
                first = near[:, once].argmax(0) if len(once) else once
                yield pd.DataFrame({"a": np.array([members[i]["node"] for i in first], np.int64), "b": np.array([rows[j]["node"] for j in once], np.int64)})

    def blocked(df: DataFrame, by: str, key: str, most: int) -> DataFrame:
        return df.join(df.groupBy(by).agg(F.ceil(F.count("*") / most).cast("long").alias("_n")), by).withColumn("_b", F.pmod(F.xxhash64(F.lit(13), key), "_n")).drop("_n")

    ball = scratch.table(probes.mapInPandas(balls, "probe long, root long, label string, centre binary, radius double"))
    packs = blocked(ball, "label", "probe", PROBES).groupBy("label", "_b").agg(F.collect_list(F.struct("probe", "root", "centre", "radius")).alias("probes")).drop("_b")
    others = nodes.join(ball.select("label").distinct(), "label", "left_semi")
    others = blocked(others, "label", "node", BLOCK).groupBy("label", "_b").agg(F.collect_list(F.struct("node", "root", "unit")).alias("rows"))
    near = scratch.table(others.join(packs, "label").select("rows", "probes").mapInPandas(near_balls, "node long, probe long"))
    met = blocked(near, "probe", "node", BLOCK).join(nodes, "node").groupBy("probe", "_b").agg(F.collect_list(F.struct("node", "root", "unit")).alias("rows"))
    return scratch.table(met.join(probes.select("probe", "members"), "probe").select("members", "rows").mapInPandas(meet, "a long, b long"))


def paired(df: DataFrame, group: str, node: str, blocks: str) -> DataFrame:
    """Rows dealt to (group, i, j): each of a group's blocks meets each other one in one task."""
    df = df.withColumn("b", F.pmod(F.xxhash64(F.lit(3), node), F.col(blocks)))
    df = df.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
    # with several blocks the pairs (b, b) are part of (b, o)
    return df.filter(f"{blocks} = 1 or b <> o").withColumns({"i": F.least("b", "o"), "j": F.greatest("b", "o")}).drop("b", "o")


def exact(nodes: DataFrame, comps: DataFrame, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, n): vectors linked with each node of a component, in double precision; and edges (a, b) that connect them."""
    size = comps.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    members = paired(comps.join(size, "root").join(nodes.select("node", "label", "n", "v"), "node"), "root", "node", "blocks")
    home = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks"))
    rows = F.struct("node", "n", "v", "label", home.alias("home"))
    packed = members.groupBy("root", "i", "j", "blocks").agg(F.collect_list(rows).alias("rows"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rows, blocks, i, j in zip(batch["rows"], batch["blocks"], batch["i"], batch["j"]):
                ids, n, home = (np.array([r[c] for r in rows]) for c in ("node", "n", "home"))
                x = np.stack([np.asarray(r["v"], np.float64) for r in rows])
                x = x / np.abs(x).max(1)[:, None]
                x = x / np.sqrt((x * x).sum(1))[:, None]
                near = x @ x.T >= threshold
                np.fill_diagonal(near, False)
                # two blocks meet once, but the pairs within a block meet wherever it goes: they count where its partner is next to it
                counts = near.copy()
                for b in (i, j):
                    if blocks > 1 and (i, j) != (min(b, (b + 1) % blocks), max(b, (b + 1) % blocks)):
                        counts &= ~np.outer(home == b, home == b)
                total = counts @ n
                edges = forest(near)
                out += [(int(a), None, int(t)) for a, t in zip(ids, total) if t] + [(int(ids[a]), int(ids[b]), 0) for a, b in edges]
            yield pd.DataFrame({"a": pd.array([x[0] for x in out], "Int64"), "b": pd.array([x[1] for x in out], "Int64"), "n": pd.array([x[2] for x in out], "Int64")})

    rows = scratch.table(packed.select("rows", "blocks", "i", "j").mapInPandas(run, "a long, b long, n long"))
    return rows.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked")), rows.filter("b is not null").select("a", "b")


def audit(nodes: DataFrame, counts: DataFrame, graph: DataFrame, saturated: DataFrame, threshold: float) -> float:
    """Least recall of links against all rows over samples of AUDITED nodes at most.

    Samples: any nodes, those with links, saturated ones, and those without links that come nearest
    to one. A sample that has no link in truth says nothing.
    """
    some = lambda df: [r["node"] for r in df.select("node").orderBy(F.xxhash64(F.lit(5), "node"), "node").limit(AUDITED).collect()]
    best = graph.groupBy(F.col("a").alias("node")).agg(F.max("sim").alias("best")).join(counts, "node", "left_anti")
    samples = [some(nodes), some(counts), some(saturated), [r["node"] for r in best.orderBy(F.desc("best"), "node").limit(AUDITED).collect()]]
    wanted = sorted({x for s in samples for x in s})
    if not wanted:
        return 1.0
    chosen = nodes.filter(F.col("node").isin(wanted)).select("node", "label", "v").collect()
    ids, labels = [r["node"] for r in chosen], np.array([r["label"] for r in chosen])
    unit = lambda m: (m := m / np.abs(m).max(1)[:, None]) / np.sqrt((m * m).sum(1))[:, None]
    queries = unit(np.array([r["v"] for r in chosen], np.float64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if len(batch):
                near = (queries @ unit(np.stack(batch["v"])).T >= threshold) & (labels[:, None] == batch["label"].to_numpy()) & (np.array(ids)[:, None] != batch["node"].to_numpy())
                total += near @ batch["n"].to_numpy()
        yield pd.DataFrame({"node": ids, "t": total})

    truth = nodes.select("node", "label", "n", "v").mapInPandas(run, "node long, t long").groupBy("node").agg(F.sum("t").alias("t"))
    pairs = {r["node"]: (r["t"], min(r["t"], r["linked"] or 0)) for r in truth.join(counts, "node", "left").collect()}
    sums = [np.array([pairs[x] for x in s]).reshape(-1, 2).sum(0) for s in samples]
    return min((float(f / t) for t, f in sums if t), default=1.0)


def link(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Vectors whose labels are equal and not null are linked if their cosine in double precision is
    at least threshold. n_links: linked rows other than itself; component_id: smallest vec_id that
    links lead to, itself included; kept: vec_id = component_id. Vectors that are null, empty, zero
    or hold a null or a non-finite component, and those with a null label or vec_id, are linked
    with nothing. Vectors are compared with those of their own length only. Equal vectors of a
    label become one node with a count.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neardup")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("l"))
    ok = usable(F.col("v")) & F.col("l").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("label", F.concat_ws("/", F.size("v").cast("string"), "l")).withColumn("node", F.when(ok, F.xxhash64("label", "v")))
    keyed = scratch.table(rows.select("vec_id", "node"))
    nodes = scratch.table(rows.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v")))
    total = nodes.count()
    done = []
    for dim in [r[0] for r in nodes.select(F.size("v")).distinct().collect()]:
        own = nodes.filter(F.size("v") == dim)
        start, graph, counts, edges = NEIGHBOURS, None, None, None
        for attempt in range(TRIES):
            unit = scratch.table(units(own, attempt))
            graph = scratch.table(refined(graph, local_join(cells(unit), unit, None, dim), threshold, start))
            for _ in range(ROUNDS):
                sym = graph.select("a", "b", "fresh").union(graph.select("b", "a", "fresh"))
                busy = sym.filter("fresh = 1").select("a").distinct()
                members = dealt(sym.select("a", "b").distinct().join(busy, "a", "left_semi").toDF("g", "node"), GROUP)
                worst = graph.groupBy(F.col("a").alias("node")).agg(F.first("least").alias("least"), F.first("k").alias("k"))
                better = scratch.table(refined(graph, local_join(members, unit, worst, dim), threshold, start))
                scratch.drop(graph)
                graph = better
                if graph.filter("fresh = 1").count() <= SETTLED * total * start:
                    break
            links = graph.filter(F.col("sim") >= threshold - MARGIN).select("a", "b")
            comps = components(scratch, links)
            saturated = scratch.table(full(graph, threshold, start))
            if not saturated.isEmpty():
                more = beyond(unit, comps, saturated, threshold, dim, scratch)
                if not more.isEmpty():
                    comps = components(scratch, links.union(more))
            counts, edges = exact(own, comps, threshold, scratch)
            if audit(own, counts, graph, saturated, threshold) >= TARGET:
                break
            start = min(MOST, 2 * start)
        else:  # missed on the last try: every pair of a label
            counts, edges = exact(own, own.select("node", F.xxhash64("label").alias("root")), threshold, scratch)
        done.append((counts, edges))
    if not done:
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts, edges = done[0]
    for c, e in done[1:]:
        counts, edges = counts.union(c), edges.union(e)
    members = nodes.select("node", "rep").join(components(scratch, edges), "node")
    members = spread_join(members, members.groupBy("root").agg(F.min("rep").alias("component_id")), "root", F.lit(24), F.col("node")).select("node", "component_id")
    named = nodes.select("node", "rep", "n").join(members, "node", "left").withColumn("component_id", F.coalesce("component_id", "rep")).join(counts, "node", "left")
    named = named.select("node", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = keyed.join(named, "node", "left")
    own_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own_id.alias("component_id"), F.coalesce(F.col("vec_id") == own_id, F.lit(True)).alias("kept"))
