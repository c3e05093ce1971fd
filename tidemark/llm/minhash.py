"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full shingle sets.

A signature has SYMBOLS minima of BITS bits. It is cut into CHUNKS; two signatures that differ in
at most (ERRORS + 1) * CHUNKS - 1 symbols agree, by the pigeonhole principle, in some chunk but
for ERRORS symbols, so each chunk gives a key for every way to leave out ERRORS symbols, and all
pairs under that distance share a key. For a similarity of 0.8 the distance is binomial with mean
16; over 31 of 80 differ with a chance of 3e-5. A key holds 4 symbols, 64 bits, so that unlike
documents hardly ever share one however many there are.

Equal sets become one class first, equal signatures one node. A group (of keys, later of
candidates) is dealt to bounded blocks, each with the group's hub: members that a block connects
with the hub are settled, and only the rest, with no cap on their number, meets all the other
blocks. Tasks return spanning forests, which lead to the same components as all links. Candidates
are components of signatures, confirmed on their whole sets by a matrix product.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import Scratch, broadcast_if, components, small_batches, spread_join, trim, words
from .lm import mixed

SYMBOLS, BITS, CHUNKS, ERRORS = 80, 16, 16, 1
DISTANCE = (ERRORS + 1) * CHUNKS - 1
#: Signatures of a block, documents and shingles of one that is confirmed; two blocks meet in a task.
SIGNATURES, BLOCK, BLOCK_SHINGLES, MOST_WORDS = 512, 256, 1_000_000, 150_000
#: Rows of one set from which on they are dealt out.
COPIES = 128
SEEDS = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Shingles:
    def __init__(self, width: int):
        self.width, self.memory = width, {}

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's shingles; of all its words if they are fewer."""
        w, memory = words(text), self.memory
        if not w:
            return np.zeros(0, np.uint64)
        if len(memory) > MOST_WORDS:
            memory.clear()
        for x in w:
            if x not in memory:
                memory[x] = xxhash.xxh3_64_intdigest(x)
        h = np.fromiter(map(memory.__getitem__, w), np.uint64, len(w))
        n = min(self.width, len(w))
        out = h[: len(h) - n + 1]
        for i in range(1, n):
            out = mixed(out) * np.uint64(3) + h[i : len(h) - n + 1 + i]
        return np.unique(mixed(out + np.uint64(n)))


def class_of(s: np.ndarray) -> int:
    """63 bits that name a set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) >> 1


def signature(s: np.ndarray) -> bytes:
    """Per symbol the low bits of the least product; sets of any size in bounded steps."""
    least = np.full(SYMBOLS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(s), 1 << 14):
        least = np.minimum(least, (s[i : i + (1 << 14), None] * SEEDS).min(0))
    return (mixed(least) & np.uint64((1 << BITS) - 1)).astype(np.uint16).tobytes()


def keys_of(sigs: np.ndarray) -> np.ndarray:
    """A row of keys for each row of symbols."""
    out = []
    for c, chunk in enumerate(np.array_split(np.arange(SYMBOLS), CHUNKS)):
        for left in combinations(range(len(chunk)), ERRORS):
            h = np.full(len(sigs), np.uint64(len(out) + 1))
            for i, place in enumerate(chunk):
                if i not in left:
                    h = mixed(h * np.uint64(3) + sigs[:, place])
            out.append(h)
    return np.stack(out, 1).view(np.int64)


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a symmetric boolean matrix connects."""
    free, out = np.ones(len(near), bool), []
    for i in range(len(near)):
        if free[i]:
            free[i], todo = False, [i]
            while todo:
                at = todo.pop()
                for j in np.flatnonzero(near[at] & free):
                    free[j] = False
                    out.append((at, int(j)))
                    todo.append(int(j))
    return out


def near_signatures(data: list[bytes]) -> np.ndarray:
    sigs = np.frombuffer(b"".join(data), np.uint16).reshape(-1, SYMBOLS)
    out = np.zeros((len(sigs), len(sigs)), bool)
    for i, s in enumerate(sigs):
        out[i] = (sigs != s).sum(1) <= DISTANCE
    return out


def near_sets(data: list[bytes], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, by products of 0-1 matrices."""
    sets = [np.frombuffer(x, np.uint64) for x in data]
    size = np.array([len(s) for s in sets], np.int64)
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(at, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    row, at = row[shared[at]], place[at[shared[at]]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both = np.zeros((len(sets), len(sets)), np.int64)
    step = 8192
    for lo in range(0, int(shared.sum()), step):
        i, j = np.searchsorted(at, (lo, lo + step))
        m = np.zeros((len(sets), step), np.float32)
        m[row[i:j], at[i:j] - lo] = 1
        both += (m @ m.T).astype(np.int64)
    return 100 * both >= percent * (size[:, None] + size - both)


def meet(members: DataFrame, payload: Callable[[DataFrame], DataFrame], near: Callable[[list[bytes]], np.ndarray], scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect in each group what near connects, whatever the group's size.

    members: (group, node, blocks, hub), a group dealt to so many blocks, one of its nodes the hub;
    payload adds the column data, which near compares.
    """

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for group, blocks, rows in zip(batch["group"], batch["blocks"], batch["rows"]):
                rows = list({r["node"]: r for r in rows}.values())
                close = near([r["data"] for r in rows])
                edges = forest(close)
                out += [(group, rows[i]["node"], rows[j]["node"]) for i, j in edges]
                if blocks > 1:
                    settled = {i for i, r in enumerate(rows) if r["hub"]}
                    todo = list(settled)
                    while todo:
                        new = set(np.flatnonzero(close[todo.pop()]).tolist()) - settled
                        settled |= new
                        todo += new
                    out += [(group, r["node"], None) for i, r in enumerate(rows) if i not in settled]
            yield pd.DataFrame({"group": pd.array([x[0] for x in out], "Int64"), "a": pd.array([x[1] for x in out], "Int64"), "b": pd.array([x[2] for x in out], "Int64")})

    def packed(rows: DataFrame, *by: str) -> DataFrame:
        rows = rows.groupBy("group", *by).agg(F.max("blocks").alias("blocks"), F.collect_list(F.struct("node", "data", "hub")).alias("rows"))
        return rows.select("group", "blocks", "rows").mapInPandas(compare, "group long, a long, b long")

    def every(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    block = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks"))
    at = F.when(F.col("hub"), every("blocks")).otherwise(F.array(block))
    first = scratch.table(packed(payload(members).withColumn("i", F.explode(at)), "i"))
    edges = first.filter("b is not null").select("a", "b")
    rest = first.filter("b is null").select("group", F.col("a").alias("node"))
    if rest.isEmpty():
        return edges
    # what the hub did not reach meets every block of its group
    parts = scratch.table(rest.groupBy("group").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("parts")))
    again = scratch.table(payload(members.join(broadcast_if(parts, F.lit(16)), "group")))
    left = again.join(rest, ["group", "node"], "left_semi").withColumn("i", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("parts"))).withColumn("j", F.explode(every("blocks")))
    right = again.withColumn("i", F.explode(every("parts"))).withColumn("j", block)
    both = left.unionByName(right).withColumns({"blocks": F.lit(1).cast("long"), "hub": F.lit(False)})
    more = scratch.table(packed(both, "i", "j"))
    return edges.union(more.select("a", "b"))


def classes(docs: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(doc_id, n_shingles, node, sig) for each row; node names the set, null if it is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(width)
        for batch in batches:
            rows = [(len(s), class_of(s), signature(s)) if len(s) else (0, None, None) for s in map(shingles.of, batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": [n for n, _, _ in rows], "node": pd.array([c for _, c, _ in rows], "Int64"), "sig": [x for _, _, x in rows]})
        trim()

    return scratch.table(docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, node long, sig binary"))


def candidates(reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) whose components hold all pairs of signatures under the distance."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                if len(sigs):
                    k = keys_of(sigs)
                    node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), k.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(k.reshape(-1)), pa.array(node)], ["key", "node"])

    # equal signatures are one: only one node of each goes on, the others have an edge to it
    one = reps.groupBy("sig").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    alone = scratch.table(one.select("sig", F.col("least").alias("node")))
    again = scratch.table(one.filter("n > 1").select("sig", "least"))
    same = reps.join(broadcast_if(again, F.lit(2 * SYMBOLS + 8)), "sig").filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    keys = alone.select("node", "sig").mapInArrow(keyed, "key long, node long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first")).filter("n > 1").select("key", "first")
    # keys with the same least node are one group: each key's nodes still meet, and only once
    met = scratch.table(keys.join(shared, "key").select("first", "node").distinct())
    # a group's rows are never dealt by the group: only groups above a block have a size to be looked up
    size = scratch.table(met.groupBy("first").agg(F.count("*").alias("n")).filter(F.col("n") > SIGNATURES).select("first", F.ceil(F.col("n") / SIGNATURES).cast("long").alias("blocks")))
    rows = met.join(broadcast_if(size, F.lit(16)), "first", "left").select(F.col("first").alias("group"), "node", F.coalesce("blocks", F.lit(1).cast("long")).alias("blocks"), (F.col("node") == F.col("first")).alias("hub"))
    return meet(rows, lambda df: df.join(alone.withColumnRenamed("sig", "data"), "node"), near_signatures, scratch).union(same)


def confirmed(docs: DataFrame, reps: DataFrame, found: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) of classes linked on their full sets, within components (node, root) of candidates."""
    chosen = found.join(reps.select("node", "rep", "n_shingles"), "node")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")
    size = scratch.table(chosen.groupBy("root").agg(blocks.alias("blocks")).filter("blocks > 1"))
    chosen = spread_join(chosen, size, "root", F.lit(24), F.col("node"))
    chosen = scratch.table(chosen.select("rep", F.col("root").alias("group"), "node", F.coalesce("blocks", F.lit(1).cast("long")).alias("blocks"), (F.col("node") == F.col("root")).alias("hub")))

    def sets(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles = Shingles(width)
            for batch in batches:
                found = [shingles.of(t) for t in batch["text"]]
                ok = np.array([len(s) > 0 and class_of(s) == w for s, w in zip(found, batch["node"])], bool)
                yield batch[ok].drop(columns="text").assign(data=[s.tobytes() for s, k in zip(found, ok) if k])
            trim()

        names = [c for c in df.columns if c != "rep"]
        texts = docs.select(F.col("doc_id").alias("rep"), "text").join(broadcast_if(df, F.lit(48)), "rep").select(*names, "text")
        return texts.mapInPandas(run, T.StructType([*df.select(*names).schema.fields, T.StructField("data", T.BinaryType())]))

    return meet(chosen, sets, functools.partial(near_sets, percent=percent), scratch).distinct()


def link(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept, class_id.

    Documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of width-word
    shingles (A-Z lower-cased). component_id is the smallest doc_id that links lead to, itself
    included; kept: doc_id = component_id. A text that is null or has no word has an empty set, is
    linked with nothing and kept. Rows with a null doc_id take no part: component_id is null, kept
    true. Rows that repeat a doc_id are rows of their own; equal sets share class_id.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = classes(docs, width, scratch)
    reps = rows.filter("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    reps = scratch.table(reps)
    found = components(scratch, candidates(reps, scratch))
    linked = components(scratch, confirmed(docs, reps, found, width, percent, scratch))
    members = reps.select("node", "rep").join(linked, "node")
    least = members.groupBy("root").agg(F.min("rep").alias("component_id"))
    members = spread_join(members, least, "root", F.lit(24), F.col("node")).select("node", "component_id")
    named = reps.select("node", "rep").join(members, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    # sets that many rows have, and rows without one, are not dealt by the set
    often = scratch.table(reps.filter(F.col("copies") > COPIES).select("node").join(named, "node"))
    scratch.keep(rows, reps, linked, often)
    seen = spread_join(rows.drop("sig"), often, "node", F.lit(24), F.col("doc_id"))
    done = F.col("node").isNull() | F.col("component_id").isNotNull()
    out = seen.filter(done).unionByName(seen.filter(~done).drop("component_id").join(named, "node", "left"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"), F.col("node").alias("class_id"))


def first_of_groups(docs: DataFrame) -> DataFrame:
    """Pipeline filter: of each group of near-duplicates (five words, 0.8) exactly one row stays.

    Rows are judged one by one, those with a null doc_id too: the smallest doc_id stays, null last,
    then the least hash of text and of row. A text that is null or has no word is in no group; of
    rows that repeat such a text and its doc_id one stays.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    name = F.when(worded, F.xxhash64(text)).otherwise(F.xxhash64(F.lit(1), text.isNull(), text, id_.isNull(), id_))
    rows = docs.select(name.alias("name"), id_.alias("id"), text.alias("t"), row.alias("row"))
    # equal texts first: only those that repeat are shuffled
    repeated = scratch.table(rows.groupBy("name").count().filter("count > 1").select("name"))
    side = broadcast_if(repeated, F.lit(8))
    order = F.struct(F.col("id").isNull(), "id", F.xxhash64("row"))
    one = rows.join(side, "name", "left_semi").groupBy("name").agg(F.min_by(F.struct("id", "t", "row"), order).alias("x"))
    one = scratch.table(one.select("name", "x.id", "x.t", "x.row"))
    rows = rows.join(side, "name", "left_anti").unionByName(one)
    found = link(rows.select(F.col("name").alias("doc_id"), F.col("t").alias("text"))).select(F.col("doc_id").alias("name"), "component_id")
    # groups of one lose nothing
    found = scratch.table(found)
    large = scratch.table(found.groupBy("component_id").count().filter("count > 1"))
    several = spread_join(found, large, "component_id", F.lit(24), F.col("name")).filter("count > 1").join(rows.select("name", "id"), "name")
    first = several.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "name"))["name"].alias("stays"))
    lost = spread_join(several, scratch.table(first), "component_id", F.lit(24), F.col("name")).filter("name <> stays").select("name")
    lost = scratch.table(lost)
    return rows.join(broadcast_if(lost, F.lit(8)), "name", "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])
