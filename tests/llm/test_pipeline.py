"""The pipeline on a small corpus: each stage against brute force on its own input."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import langid, mixing
from tidemark.llm.queries import tokenizer_path

from .test_operators import DOCS, brute_lines, components_of, texts, words


def test_stages(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    rows = [(i, t, "en", ["a", "b"][i % 2], len(t) if t else None, 1, "s", 2, 0.5) for i, t in enumerate([*texts(3, 40), "12 34 !"])]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "bpe" or docs.columns == before.columns
        seen.append([(r["doc_id"], r["text"]) for r in docs.collect()] if name != "bpe" else docs.collect())
    language, lines, near, mixed, tokens = seen
    scores = {r["doc_id"]: r["score"] for r in langid.identify(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()}
    assert sorted(i for i, _ in language) == [r[0] for r in rows if scores[r[0]] >= langid.CONFIDENT]
    assert not {r[0] for r in rows if not r[1] or not any(map(str.isalpha, r[1]))} & {i for i, _ in language}

    hashed = [(r["doc_id"], r["h"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/language_id").select("doc_id", F.xxhash64("text").alias("h"), "text").collect()]
    gone = brute_lines(hashed, 50)
    assert sorted(lines) == sorted((d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, h])) for d, h, t in hashed) and any(gone.values())

    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = {d: shingles(t) for d, t in lines}
    comp = components_of(set(sets), [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert sorted(near) == sorted((d, t) for d, t in lines if comp[d] == d) and len(near) < len(lines)

    size = {d: len(words(t)) for d, t in near}
    taken = collections.Counter()
    for d, t in mixed:
        taken[d] += len(words(t))
    assert set(taken) <= set(size) and all(taken[d] <= 3 * size[d] for d in taken)
    assert abs(sum(taken.values()) - sum(size.values())) <= 2 and mixing.BLOCK

    lib = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = collections.Counter((d, hashlib.sha256(np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for d, t in mixed)
    assert collections.Counter((r["doc_id"], r["ids_sha256"]) for r in tokens) == want
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(tokens)


def chained(spark, tmp_path, name, rows, schema):
    folder = f"{tmp_path}/{name}"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, folder).collect()


def test_chain_of_odd_rows(spark, tmp_path):
    """Empty tables, null ids, repeated rows, columns of clashing names: defined results after all stages."""
    pytest.importorskip("public_tokenizers")
    plain = "doc_id long, text string, lang string, source string, n_chars long"
    assert chained(spark, tmp_path, "none", [], plain) == []
    assert chained(spark, tmp_path, "blank", [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "12 !", "en", "a", 4)], plain) == []
    text = lambda k: " ".join(f"word{k}and{i}" for i in range(120))
    rows = [(1, text(1), "en", "a", 1), (1, text(1), "en", "a", 1), (None, text(2), "en", None, 1), (None, text(2), "en", None, 1), (2, text(1), "en", "b", 1), (3, text(3), None, "a", 1)]
    got = chained(spark, tmp_path, "repeats", rows, plain)
    assert {r["doc_id"] for r in got} == {1, None, 3} and all(r["n_tokens"] for r in got)
    clash = plain + ", " + ", ".join(f"{c} string" for c in "score lang_pred node size taken start row shards slots block name component_id n_lines path h t d s n x".split())
    more = [(*r, *["c"] * 20) for r in rows]
    again = chained(spark, tmp_path, "clash", more, clash)
    key = lambda rs: sorted(((r["doc_id"], r["ids_sha256"]) for r in rs), key=str)
    assert key(again) == key(got)


def test_no_plan_runs_many_jobs(spark, tmp_path):
    """What runs at once is in the driver's memory at once."""
    rows = [(i, t, "en", ["a", "b"][i % 2], len(t) if t else None, 1, "s", 2, 0.5) for i, t in enumerate(texts(3, 40))]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs, store = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark._jsparkSession.sharedState().statusStore()
    for name, stage in corpus_pipeline.STAGES:
        if name not in ("line_dedup", "mixing"):
            continue
        before = store.executionsCount()
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        jobs = [store.executionsList().apply(i).jobs().size() for i in range(before, store.executionsCount())]
        print(name, sorted(jobs))
        assert jobs and max(jobs) <= 10
