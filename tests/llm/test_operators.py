"""Each training-data operator on a small fixture with nulls, empties, repeats and clashing columns, held against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import ann, base, bpe, html, langid, linededup, lm, minhash, mixing, neardup, urlfilter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, start string, node int, score double"


def words(t):
    return (t or "").encode().lower().split()


def texts(seed=1, n=60):
    """Random texts with exact copies, near copies, shared passages, repeats, nulls and blanks."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeiou") + r.choice("bcdfgklm") for _ in range(r.randrange(1, 4)))
    line = lambda k: " ".join(word() for _ in range(k))
    passage = [line(30), line(15), line(20)]
    out = [None, "", " \t\n ", "One", "one", "É É", "x" * 3000, "a  b\x0bc\u00a0d"]
    for _ in range(n):
        out.append("\n".join(line(r.randrange(1, 30)) for _ in range(r.randrange(1, 8))))
    out += [out[12], out[12].upper(), out[13] + " tail", "\n".join([line(5), *passage, line(4)]), "\n".join([line(9), *passage, "", line(3)]), "\n".join(["same line here"] * 80)]
    long = line(400).split()
    for i in range(5):
        copy = list(long)
        copy[10 * i : 10 * i + 4] = ["changed"] * 4
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], [None, "b", "a", "a", "é"][i % 5], len(t) if t else None, 1, "s", 2, 0.5) for i, t in enumerate(texts())]
    rows += [(None, "no id at all", "en", "a", 12, 1, "s", 2, 0.5), rows[20], rows[20], rows[1], (30, "another text of the same id", "en", "b", 1, 1, "s", 2, 0.5)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(25)] + [(7, 7)]
    got = {x["node"]: x["root"] for x in base.components(base.Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = components_of(nodes, [e for e in edges if e[0] != e[1]])
    assert set(got) == nodes
    assert {frozenset(n for n in nodes if got[n] == k) for k in set(got.values())} == {frozenset(n for n in nodes if want[n] == k) for k in set(want.values())}


def brute_lines(rows, least):
    """Every window of lines with least words, longest runs included, whose copy stands earlier."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seqs = [(k, [(i, x) for i, x in enumerate((t or "").split("\n")) if words(x)]) for k, t in [((r[0], r[1]), r[2]) for r in order]]
    seen, gone = {}, collections.defaultdict(set)
    for k, s in seqs:
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                run = tuple(x for _, x in s[a:b])
                if sum(len(words(x)) for x in run) >= least:
                    if run in seen:
                        gone[k] |= {i for i, _ in s[a:b]}
                    seen.setdefault(run, (k, a))
    return gone


def test_line_dedup(spark, docs, none):
    out = linededup.dedup(docs.withColumn("n_removed", F.lit("clash"))).withColumn("h", F.xxhash64("text")).collect()
    assert len(out) == docs.count() and list(linededup.dedup(docs).columns) == [*docs.columns, "n_lines", "n_removed"]
    rows = [(r["doc_id"], r["h"], r["text"]) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).distinct().collect()]
    gone = brute_lines(rows, 50)
    want = collections.Counter()
    for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect():
        t, g = r["text"], gone[r["doc_id"], r["h"]]
        want[r["doc_id"], None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in g), len(g)] += 1
    assert collections.Counter((r["doc_id"], r["text"], r["n_removed"]) for r in out) == want
    assert sum(map(len, gone.values())) > 80
    assert linededup.dedup(none).count() == 0


def brute_lm(train):
    """P(w | u, v) of an interpolated modified Kneser-Ney trigram model; 1: before a text, 0: its end."""
    grams = [(u, v, w) for t in train for u, v, w in zip([1, 1, *t], [1, *t], t)]
    c3, raw = collections.Counter(grams), collections.Counter((v, w) for _, v, w in grams)
    c2 = collections.Counter((v, w) for _, v, w in c3)
    c2 |= {p: n for p, n in raw.items() if p[0] == 1}
    before = collections.Counter(w for _, w in c2)
    counts = lambda c: [sum(x == i for x in c.values()) for i in (1, 2, 3, 4)]
    d1, d2, d3 = (lm.discounts(*counts(c)) for c in (before, c2, c3))
    after2, after3 = collections.defaultdict(list), collections.defaultdict(list)
    for (v, _), n in c2.items():
        after2[v].append(n)
    for (u, v, _), n in c3.items():
        after3[u, v].append(n)
    types, distinct = len(c2), len(before)
    left = sum(d1[min(x, 3)] for x in before.values())

    def p(u, v, w):
        out = max(before[w] - d1[min(before[w], 3)], 0) / types + left / types / (distinct + 1)
        if after2[v]:
            out = (max(c2[v, w] - d2[min(c2[v, w], 3)], 0) + sum(d2[min(n, 3)] for n in after2[v]) * out) / sum(after2[v])
        if after3[u, v]:
            out = (max(c3[u, v, w] - d3[min(c3[u, v, w], 3)], 0) + sum(d3[min(n, 3)] for n in after3[u, v]) * out) / sum(after3[u, v])
        return out

    return p


def test_lm(spark, docs, none, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    train = [[*words(t), 0] for d, t in rows if not held(d)]
    c1 = collections.Counter(w for t in train for w in t)
    n, v, p = sum(c1.values()), len(c1), brute_lm(train)
    for u, x in ((1, 1), (1, train[9][0]), (train[9][0], train[9][1]), ("no", "such"), ("no", train[9][0])):
        assert abs(sum(p(u, x, w) for w in c1) + p(u, x, "unseen") - 1) < 1e-9
    want = collections.defaultdict(list)
    for d, t in rows:
        s = [*words(t), 0]
        want[d].append((held(d), len(s), sum(c1[w] > 0 for w in s), round(sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s), 6), round(sum(math.log10(p(*x)) for x in zip([1, 1, *s], [1, *s], s)), 6)))

    def check():
        got = collections.defaultdict(list)
        for r in lm.score(docs).collect():
            assert r["train_tokens"] == n
            got[r["doc_id"]].append((r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)))
        assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}

    check()
    assert lm.score(none).count() == 0
    alone = lm.score(docs.filter("doc_id = 12").limit(1), F.lit(True)).first()  # nothing to learn from
    assert alone["n_known"] == 0 and alone["score"] == 0


def test_lm_in_pieces():
    """Texts that are cut, interned words that are forgotten and counts over a byte change nothing."""
    r = random.Random(6)
    some = [" ".join(r.choice("abcdefghij") + r.choice("uvw") for _ in range(k)) for k in (0, 1, 2, 7, 300, 2000)] + [None, "a b " * 900, " \t x\x0by\u00a0z \x85 \u2028É é\n", "\n", "A a"]
    own = {k: getattr(lm, k) for k in ("TEXT_BYTES", "PIECE", "HELD", "RADIX")}

    def found(*common):
        named = np.array([*lm.MARKS, *(xxhash.xxh3_64_intdigest(w) >> 16 for w in common)], np.uint64)
        out = collections.Counter()
        for _, b in lm.counted(iter([pa.array(some[:3]), pa.array(some[3:])]), 5, named):
            names, columns, n = lm.unpacked(b)
            names = np.concatenate([named, names])
            for x in zip(*(names[c].tolist() for c in columns), n[0].tolist()):
                out[x[:3]] += x[3]
        return out

    whole = found()
    try:
        for lm.TEXT_BYTES, lm.PIECE, lm.HELD, lm.RADIX in ((7, 20, 5, 1 << 21), (1 << 20, 50, 1000, 64), (1, 1, 1, 1 << 21)):
            assert found() == whole == found(b"au", b"bv", b"a", b"none")
    finally:
        for k, x in own.items():
            setattr(lm, k, x)
    name = lambda w: xxhash.xxh3_64_intdigest(w) >> 16
    begin, end = (int(x) for x in lm.MARKS)
    want = collections.Counter(x for t in some for s in [[begin, begin, *map(name, words(t)), end]] for x in zip(s, s[1:], s[2:]))
    assert whole == want
    assert sum(whole.values()) == sum(len(words(t)) + 1 for t in some)
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 500, np.uint64))
    sums = np.random.default_rng(2).integers(0, 400, (5, 500)) * np.where(np.arange(500) % 9, 1, 10**10)
    table = lm.Table(b"".join(bytes(x) for x in lm.Table.parts(h, sums)))
    assert (table.of(h) == sums.T).all() and not table.of(lm.mixed(h)).any()


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] + [1.0] * 15, 1), (1004, [], 1), (None, [1.0] * 16, 1), (1005, [1.0, 2.0], 1), (1006, [1.0, 2.0], 1)]
    for i in range(400):
        rows.append((i, rng.standard_normal(16).tolist(), int(rng.integers(3))))
    for i in range(150):
        rows.append((400 + i, (np.array(rows[8 + i % 20][1]) * 2 + rng.standard_normal(16) * 0.12).tolist(), rows[8 + i % 20][2]))
    centre = rng.standard_normal(16)
    rows += [(2000 + i, (centre + rng.standard_normal(16) * 0.01).tolist(), 2) for i in range(700)]
    return [*rows, rows[30], rows[31], (3000, rows[32][1], None), (3001, rows[33][1], 77)]


def test_neardup(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"node": F.lit("x"), "n": F.lit(1)})
    out = neardup.link(df).collect()
    assert len(out) == len(rows)
    good = [(i, np.array(v, float), k) for i, v, k in rows if i is not None and k is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = collections.Counter()
    pairs = []
    for a, (i, v, k) in enumerate(good):
        for j, w, m in good[:a]:
            if k == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    twice = collections.Counter(r[0] for r in rows)
    comp = components_of({r[0] for r in rows if r[0] is not None}, [(a, b) for a, b in pairs if a != b])
    for r in out:
        if r["vec_id"] is not None:
            assert (r["component_id"], r["kept"]) == (comp[r["vec_id"]], r["vec_id"] == comp[r["vec_id"]])
            if twice[r["vec_id"]] == 1:
                assert r["n_links"] == links[r["vec_id"]]
    assert neardup.link(df.limit(0)).count() == 0


def test_nearest(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit(1))
    good = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    got = collections.defaultdict(list)
    for r in ann.nearest(df, 50, 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hit = total = 0
    for q in [i for i in good if i % 50 == 0]:
        near = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        assert [s for _, s in got[q]] == sorted(s for _, s in got[q]) and len(got[q]) == len(near)
        for i, s in got[q]:
            assert s == pytest.approx(float(np.sqrt(((good[i] - good[q]) ** 2).sum())), rel=1e-14)
        hit, total = hit + len({i for _, i in near} & {i for i, _ in got[q]}), total + len(near)
    assert hit >= 0.95 * total and set(got) == {i for i in good if i % 50 == 0}
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.chi_square(ann.quantile(0.9, 8), 8) == pytest.approx(0.9)


def exact_nearest(rows, every, k):
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        out[int(ids[i])] = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
    return out


def test_nearest_over_many_cells(spark, monkeypatch):
    """Small cells, blocks of cells and of queries: clustered data, recall, ties between equal vectors, and what is verified."""
    monkeypatch.setattr(ann, "CELL", 100)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    monkeypatch.setattr(ann, "MOST_CELLS", 12)
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((40, 24))
    rows = [(i, (centres[i % 40] + 0.1 * rng.standard_normal(24)).tolist()) for i in range(2400)]
    rows += [(3000 + i, rows[0][1]) for i in range(40)]  # ties: copies of a query
    got = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    want = exact_nearest(rows, 20, 10)
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))
    assert got[0] == list(range(3000, 3010)) and got[3000] == [0, *range(3001, 3010)]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    verified = [n for *_, n in ann.search(ids, x, ids[:50], x[:50], 10)]
    assert np.mean(verified) < 0.2 * len(x)


def test_mixing(spark, docs, none):
    out = mixing.plan(docs).collect()
    assert sorted(map(str, out)) == sorted(map(str, mixing.plan(docs.repartition(5)).collect())) and len(out) == docs.count()
    size = collections.Counter()
    for r in docs.collect():
        size[r["source"]] += len(words(r["text"]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(size.values())
    while over := [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * size[s]]:
        share = left / sum(weight[x] for x in free)
        for s in over:
            target[s] = 3 * size[s]
        free -= set(over)
        left -= sum(target[s] for s in over)
        del share
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    taken = collections.Counter()
    for r in out:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order)
    assert all((r["shards"] == []) == (r["taken"] == 0) for r in out)
    assert collections.Counter((r["doc_id"], r["size"]) for r in out) == collections.Counter((r["doc_id"], len(words(r["text"]))) for r in docs.collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and sum(len(words(r["text"])) for r in mixed.collect()) == sum(taken.values())
    assert mixing.plan(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_mixing_meets_small_targets(spark, monkeypatch):
    sizes = {"a": 9, "b": 20, "c": 90, "d": 10_000, "e": 64, "f": 130, "g": 0}
    rows = [(i, " ".join(f"{s}{j}" for j in range(n)), s) for i, (s, n) in enumerate(sizes.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["source"]: r for r in mixing.plan(df).collect()}
    assert [got[s]["target"] for s in "abc"] == [27, 60, 270]
    for s, n in sizes.items():
        assert abs(got[s]["taken"] - got[s]["target"]) <= 0.5 and got[s]["taken"] <= 3 * n
    taken = collections.Counter()
    monkeypatch.setattr(mixing, "SHARD", 8)
    blocks = mixing.mixed_blocks(df).collect()
    for r in blocks:
        taken.update(r["text"].split())
        assert r["n_words"] == len(r["text"].split()) <= mixing.BLOCK and all(w[0] == r["source"] for w in r["text"].split())
    for s, n in sizes.items():  # every word once before any twice
        times = [taken[f"{s}{j}"] for j in range(n)]
        assert n == 0 or max(times) - min(times) <= 1 and sum(times) == got[s]["taken"]
    seen = collections.defaultdict(set)
    for r in blocks:
        seen[r["source"]].add(r["shard"])
    own = {r["source"]: r["shards"] for r in mixing.plan(df).collect()}
    assert {s: sorted(x) for s, x in seen.items()} == {s: x for s, x in own.items() if x}


def test_mixing_draws_shards_multinomially(spark):
    """Chi-square of the counts over shards and sources against the sources' shares, and no two shards alike."""
    per = spark.createDataFrame([(s, i, n) for i, (s, n) in enumerate({"a": 30_000, "b": 300_000, "c": 70_000, "d": 0, "e": 9_600}.items())], "skey string, place long, slots long")
    total, seen = 409_600, collections.defaultdict(dict)
    for r in mixing.counts(per, 7).collect():
        seen[r["shard"]][r["skey"]] = r["n"]
    share = {"a": 30_000 / total, "b": 300_000 / total, "c": 70_000 / total, "e": 9_600 / total}
    assert len(seen) == total // mixing.SHARD and all(sum(x.values()) == mixing.SHARD for x in seen.values())
    chi = sum((x.get(s, 0) - mixing.SHARD * p) ** 2 / (mixing.SHARD * p) for x in seen.values() for s, p in share.items())
    free = len(seen) * (len(share) - 1)
    assert abs(chi - free) < 5 * math.sqrt(2 * free) and len({tuple(sorted(x.items())) for x in seen.values()}) > 0.9 * len(seen)
    assert mixing.counts(per.limit(0), 7).count() == 0


def test_permutation(spark):
    for n in (1, 2, 7, 64, 1000):
        keys = F.array(*[F.pmod(F.xxhash64(F.lit(r)), F.lit(n)) for r in range(mixing.ROUNDS)])
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), keys, 5).alias("y")).collect()
        assert sorted(r["y"] for r in got) == list(range(n))


def test_bpe(spark, docs, none):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    more = spark.createDataFrame([(900, "a<|endoftext|>b", "en", "a", 1, 1, "", 1, 0.0), (901, "\u2028 x\x1c\u00a0y  " + "ab" * 4000, "en", "a", 1, 1, "", 1, 0.0), (902, "日本語 🙂 'll 'S 12", "en", "a", 1, 1, "", 1, 0.0)], DOCS)
    every = docs.union(more)
    want = collections.Counter()
    for r in every.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want[r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = bpe.encode(every, path).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(r["decoded"] is not None for r in got) and bpe.encode(none, path).count() == 0


def test_bpe_learns_a_word_once_a_batch(monkeypatch):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    lib, enc, learned = tokenizers.Tokenizer.from_file(path), bpe.TrieEncoder(path), []
    r = random.Random(5)
    name = lambda: "".join(r.choice("bdfgkl") + r.choice("aeiouéß") for _ in range(4))
    common = [name() for _ in range(30)]
    batches = [[" ".join(common + [name() for _ in range(20)]) + "<|endoftext|>" + common[0] for _ in range(8)] for _ in range(3)]
    want = [[np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in batch] for batch in batches]
    trie = enc.trie
    monkeypatch.setattr(enc, "trie", lambda ordered: learned.extend(ordered) or trie(ordered))
    monkeypatch.setattr(bpe, "MOST_WORDS", 220)  # a batch has about 190
    for batch, ids in zip(batches, want):
        assert enc.encode(batch) == ids
        assert len(set(learned)) == len(learned)  # those that repeat outlive the rest
    for most in (1, 7, 40):
        monkeypatch.setattr(bpe, "MOST_WORDS", most)
        assert [enc.encode(batch) for batch in batches] == want and len(enc.known) == len(enc.numbers) <= most


def test_minhash(spark, docs, none):
    for width in (2, 5):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

        def shingles(t, k=width):
            w = words(t)
            return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

        sets = [(d, shingles(t)) for d, t in rows]
        links = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t)]
        comp = components_of({d for d, _ in rows if d is not None}, [p for p in links if p[0] != p[1]])
        want = collections.Counter((d, len(s), None if d is None else comp[d] if s else d, d is None or d == comp[d] or not s) for d, s in sets if d != 30)
        got = minhash.link(docs, width).collect()
        assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] != 30) == want
    kept = minhash.first_of_groups(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 1 and minhash.link(none).count() == 0


def test_keys_meet_under_the_distance():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << minhash.BITS, (40, minhash.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[r.choice(minhash.SYMBOLS, minhash.DISTANCE, replace=False)] += 1
    assert (minhash.keys_of(a) == minhash.keys_of(b)).any(1).all()


def test_broadcast_bound(spark):
    from tidemark.llm.base import MOST_BROADCAST, broadcast_if

    one = spark.createDataFrame([("x" * 100,)], "s string")
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(broadcast_if(one, F.octet_length("s")))
    assert "broadcast" not in plan(broadcast_if(one, F.octet_length("s"), 99))
    assert "broadcast" in plan(broadcast_if(one.limit(0), F.lit(MOST_BROADCAST)))


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1", "http://www.example.com/en/x?y=/es/", "http://a.www.example.com/en/", "http://shop.net/es/1", "http://net/fr/#x", "http://xnet/fr/", "http://b.example.com", "http://c.com/", "http://b.example.org/en/1", "https://blog.example.org/en/2", "a://b.org/c://d.com/", "x://h\nost.com/p\n?q", "http://\ud83d\ude00.org/" + "x" * 100_000]
    df = spark.createDataFrame([*enumerate(urls), (None, "http://c.com/"), (4, urls[4])], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in urlfilter.judge(df).collect()}
    rule = {i: got[i]["rule"] for i in range(len(urls))}
    assert rule == dict.fromkeys(range(17)) | {4: "example.com/en/", 5: "www.example.com/en/", 6: "www.example.com/en/", 7: "net/es/", 8: "net/fr/", 11: "com/", 15: "com/"}
    assert [got[i]["verdict"] for i in (4, 5, 6, 7, 8, 11)] == ["block", "allow", "allow", "block", "block", "allow"]
    assert (got[4]["host"], got[4]["path"], got[8]["path"], got[3]["host"], got[14]["host"]) == ("example.com", "/en/1", "/fr/", "", "b.org")
    assert all(r["verdict"] in ("allow", "block") and 0 <= r["p_block"] <= 1 for r in got.values())
    assert urlfilter.judge(df).count() == len(urls) + 2 and urlfilter.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(df, []).collect()} == {"allow"}  # nothing to learn from


def made_urls(seed, n):
    """Hosts of a bad suffix or with long random names are bad, on paths that say nothing."""
    r, out = random.Random(seed), []
    for i in range(n):
        bad = r.random() < 0.4
        name = "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789" if bad else "aeiourstln", k=r.randrange(9, 16) if bad else r.randrange(4, 9)))
        tld = r.choice(["zip", "zip", "org"] if bad else ["org", "org", "net"])
        out += [(f"http://{name}-{i}.{tld}/{r.choice(['a', 'b', 'news'])}/{r.randrange(99)}", bad, f"{name}-{i}.{tld}")] * 2
    return out


def test_urls_of_unseen_hosts(spark):
    seen, unseen = made_urls(1, 400), made_urls(2, 200)
    rules = [("block" if bad else "allow", host, "/") for _, bad, host in dict.fromkeys(seen)]
    rows = [u for u, _, _ in seen + unseen]
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(spark.createDataFrame([*enumerate(rows)], "page_id long, url string"), rules).collect()}
    right = [(got[len(seen) + i] == "block") == bad for i, (_, bad, _) in enumerate(unseen)]
    assert sum(right) >= 0.85 * len(right)
    lost = [got[len(seen) + i] == "block" for i, (_, bad, _) in enumerate(unseen) if not bad]
    assert sum(lost) <= 0.05 * len(lost)
    y = np.array([b for _, b, _ in seen], float)
    with_, without = (urlfilter.Model([u for u, _, _ in seen], y, set(), s).blocked([u for u, _, _ in unseen]) for s in (True, False))
    hit = lambda p: np.mean((p > 0.5) == np.array([b for _, b, _ in unseen]))
    assert hit(with_) >= hit(without) >= 0.7


def brute_trees(x, y, weight, cuts, first):
    """Boosting by plain recursion over all cuts of all features."""

    def grow(rows, g, h, depth):
        gain, best = 1e-6, None
        total = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for k in range(x.shape[1] if depth else 0):
            for c in range(len(cuts[k])):
                low = [i for i in rows if np.searchsorted(cuts[k], x[i, k]) <= c]
                high = [i for i in rows if i not in set(low)]
                if low and high:
                    new = g[low].sum() ** 2 / (h[low].sum() + 1) + g[high].sum() ** 2 / (h[high].sum() + 1) - total
                    if new > gain + 1e-9:
                        gain, best = new, (low, high)
        if best is None:
            return dict.fromkeys(rows, urlfilter.RATE * g[rows].sum() / (h[rows].sum() + 1))
        return grow(best[0], g, h, depth - 1) | grow(best[1], g, h, depth - 1)

    f = np.full(len(y), first)
    for _ in range(urlfilter.TREES):
        p = 1 / (1 + np.exp(-f))
        step = grow(list(range(len(y))), weight * (y - p), weight * p * (1 - p), urlfilter.DEPTH)
        f = f + np.array([step[i] for i in range(len(y))])
    return 1 / (1 + np.exp(-f))


def test_boosting_equals_plain_recursion(monkeypatch):
    monkeypatch.setattr(urlfilter, "TREES", 6)
    r = np.random.default_rng(3)
    x = np.round(r.standard_normal((60, 3)), 1)
    y, weight = (x[:, 0] * x[:, 1] + 0.3 * r.standard_normal(60) > 0).astype(float), r.uniform(0.5, 2, 60)
    model = urlfilter.Boosted(x, y, weight)
    assert np.allclose(model.blocked(x), brute_trees(x, y, weight, model.cuts, model.first), atol=1e-9)


def test_langid(spark, none):
    r = random.Random(8)
    parts = {"en": "the and ing ion of to er", "fr": "le que eau oui ment é ç", "de": "der sch ung ei ich ß ü"}
    rows = [(i, " ".join("".join(r.choices(parts[k].split(), k=2)) for _ in range(r.randrange(20, 60))), k, "s", 1, 1, "", 1, 0.0) for i in range(300) for k in [r.choice("en fr de".split())]]
    odd = [(1000, None, "en", "s", 1, 1, "", 1, 0.0), (1001, "12 !? \u2605", "en", "s", 1, 1, "", 1, 0.0), (None, "the and of", None, "s", 1, 1, "", 1, 0.0), rows[0], (1002, "", "fr", "s", 1, 1, "", 1, 0.0)]
    df = spark.createDataFrame([*rows, *odd], DOCS)
    out = langid.identify(df).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= x["score"] <= 1 for x in out)
    truth = {x[0]: x[2] for x in rows}
    held = [x for x in out if x["doc_id"] in truth and zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2]
    assert sum(x["lang_pred"] == truth[x["doc_id"]] for x in held) >= 0.97 * len(held) > 0
    assert all((x["lang_pred"], x["score"]) == ("und", 0) for x in out if x["doc_id"] in (1000, 1001, 1002))
    swapped = langid.identify(df, F.lit(False)).count()
    assert swapped == len(out) and langid.identify(none).count() == 0
    kept = langid.confident(df)
    score = collections.Counter(x["score"] >= langid.CONFIDENT for x in out)
    assert kept.columns == df.columns and kept.count() == score[True] and len(out) - 6 <= score[True] <= len(out) - 3


def test_langid_equals_plain_kernel_ridge():
    """The folded weights against Nystroem features of kernels that are counted set by set, and ridge by normal equations."""
    r = random.Random(5)
    parts = {"en": "the and ing ion of to er", "fr": "le que eau oui ment é ç", "de": "der sch ung ei ich ß ü"}
    text = lambda k: " ".join("".join(r.choices(parts[k].split(), k=2)) for _ in range(r.randrange(2, 30)))
    langs = [r.choice("en fr de".split()) for _ in range(60)]
    train = [text(k) for k in langs]
    model = langid.fit(train, langs)
    new = [text(k) for k in "en fr de".split() * 5] + ["x", "the"]
    sets = lambda ts: [set(langid.grams(t, model.bits).tolist()) for t in ts]
    kernel = lambda a, b: np.array([[len(x & z) / math.sqrt(len(x) * len(z)) for z in b] for x in a])
    own = sets(train)
    gram = kernel(own, own)  # all are landmarks
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    labels = sorted(set(langs))
    y = np.where(np.array(langs)[:, None] == np.array(labels), 1.0, -1.0)
    w = np.array([len(langs) / langs.count(k) for k in langs])[:, None]
    x = gram @ half
    beta = np.linalg.solve(x.T @ (w * x) + langid.RIDGE * len(langs) / x.shape[1] * np.eye(x.shape[1]), x.T @ (w * y))
    assert model.labels == labels and np.allclose(model.scores(new), kernel(sets(new), own) @ half @ beta, atol=2e-3)
    monkey = langid.MOST_CELLS
    try:
        langid.MOST_CELLS = 1
        assert np.allclose(langid.Model(model.labels, model.weights).scores(new), model.scores(new), atol=1e-5)
    finally:
        langid.MOST_CELLS = monkey


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a = "</p><p>no";</script></head><body class="has-sidebar">
<header>Site</header><nav><ul><li><a href="/">Home</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id=main><div class="post post-%d"><article><h1>A &amp; B</h1><p>First <b>bold</b>
 text&nbsp;here &lt;ok&gt;<br>line<p>Second &am with 3 < 4 <!-- gone --> and more words to read here<ul><li>one<li>two</ul>
<form><input>Mail <button>Go</button></form><aside>See also</aside><div class="ad">Buy!</div></article>
<section id="comments"><p>A long comment by a reader that says a lot of things, none of them worth it.</p></section></div></div>
<div class=sidebar>Popular</div><footer>(c)</footer></body></html>"""


def test_html(spark):
    pages = [(i, f"http://h.org/{i}", PAGE % i) for i in range(5)] + [(9, None, None), (10, "x", ""), (11, "http://h.org/z", "plain words only"), (None, "http://h.org/q", "<p>Alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "path": F.lit(1)})
    got = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    want = "A & B\nFirst bold text here <ok> line\nSecond &am with 3 < 4 and more words to read here\none\ntwo"
    assert [got[i] for i in range(5)] == [want] * 5
    assert (got[9], got[10], got[11], got[None]) == ("", "", "plain words only", "Alone")
    assert all(r["n_chars"] == len(r["text"]) for r in html.extract(df).collect()) and html.extract(df.limit(0)).count() == 0
