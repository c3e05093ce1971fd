"""Language identification with a string kernel.

Kernel: blended-spectrum presence, the number of character n-grams of length 1 to GRAMS that two
texts share, over the root of the product of their numbers. n-grams are hashed to 2**BITS places.
Nyström landmarks make the feature map, one-versus-rest kernel ridge regression the classifier.
A text's scores are K(text, landmarks) @ A; since K is itself presence @ landmark presence, both
products fold into one matrix of n-gram weights, and texts are scored in batches by the product of
their presence matrix with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import remainder, small_batches, trim

GRAMS, BITS, LEAST_BITS = 3, 18, 14
#: Bounds of the fit: labelled rows a language (about) and in all, landmarks (one a language at least),
#: characters of a text that the fit may use (a longer one counts, from its first letter on, where
#: its language has no shorter; prediction has no bound), weights. All languages are learned: the
#: more they are, the fewer are rows of each and places.
MOST_ROWS, ALL_ROWS, LEAST_ROWS, MOST_LANDMARKS, MOST_CHARS, MOST_WEIGHTS = 500, 30_000, 4, 320, 50_000, 1 << 24
RIDGE = 1e-2
#: Cells (at most, but for one text) of the matrix by which a batch of texts is scored.
MOST_CELLS = 1 << 22
#: The pipeline rejects texts whose winner's score is below: its regression, 1 for its own texts and -1 for others, is under -0.1.
CONFIDENT = 0.45


def bits_for(langs: int) -> int:
    """Bits of a place: BITS up to 64 languages, one less whenever they double."""
    bits = BITS
    while bits > LEAST_BITS and langs << bits > MOST_WEIGHTS:
        bits -= 1
    return bits


def rows_for(langs: int) -> int:
    """Labelled rows of each language."""
    return max(LEAST_ROWS, min(MOST_ROWS, ALL_ROWS * min(MOST_LANDMARKS, langs) // langs // langs))


def grams(text: str, bits: int = BITS) -> np.ndarray:
    """Places of the distinct n-grams of the whole lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    seen = np.zeros(1 << bits, bool)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] * np.uint32(0x01000193)) ^ c[n - 1 :]
        mixed = (h + np.uint32(n)) * np.uint32(0x9E3779B1)
        seen[(mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - bits)] = True
    return np.flatnonzero(seen)


class Model:
    """labels: the languages; weights: a row for each place, a column for each language."""

    def __init__(self, labels: list[str], weights: np.ndarray):
        self.labels, self.weights, self.bits = labels, weights, len(weights).bit_length() - 1

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row a text: the regressions' values, about 1 for the text's language and -1 for others."""
        out, at, held, size = np.zeros((len(texts), len(self.labels)), np.float32), 0, [], 0
        for i, t in enumerate(texts):
            held.append(grams(t, self.bits))
            size += len(held[-1])
            if size * len(held) > MOST_CELLS or i + 1 == len(texts):
                out[at : i + 1] = self.product(held)
                at, held, size = i + 1, [], 0
        return out

    def product(self, sets: list[np.ndarray]) -> np.ndarray:
        """Presence of n-grams, texts by places, times the weights of these places."""
        n, every = np.array([len(s) for s in sets]), np.concatenate(sets)
        seen = np.zeros(1 << self.bits, bool)
        seen[every] = True
        column = np.cumsum(seen)
        presence = np.zeros((len(sets), int(column[-1])), np.float32)
        presence[np.repeat(np.arange(len(sets)), n), column[every] - 1] = np.repeat(1 / np.sqrt(np.maximum(n, 1)), n)
        return presence @ self.weights[seen]


def fit(texts: list[str], langs: list[str]) -> Model:
    labels = sorted(set(langs))
    if not labels:
        return Model([], np.zeros((1 << BITS, 0), np.float32))
    bits = bits_for(len(labels))
    sets = [grams(t, bits).astype(np.int32) for t in texts]
    root = np.sqrt([max(1, len(s)) for s in sets])
    by = {k: [] for k in labels}
    for i, x in enumerate(langs):
        by[x].append(i)
    marks = [by[k][j] for j in range(max(map(len, by.values()))) for k in labels if j < len(by[k])][: max(MOST_LANDMARKS, len(labels))]
    places = np.unique(np.concatenate([sets[i] for i in marks]))  # other places meet no landmark
    row = np.full(1 << bits, -1, np.int32)
    row[places] = np.arange(len(places))
    presence = np.zeros((len(places), len(marks)), np.float32)
    for j, i in enumerate(marks):
        presence[row[sets[i]], j] = 1 / root[i]
    kernel = np.stack([presence[(r := row[s])[r >= 0]].sum(0) / n for s, n in zip(sets, root)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ half
    target = np.where(np.array(langs)[:, None] == np.array(labels), 1.0, -1.0)
    weigh = np.sqrt(len(langs) / np.array([len(by[x]) for x in langs]))[:, None]  # languages count alike
    x, y = features * weigh, target * weigh
    ridge = np.linalg.solve(x.T @ x + RIDGE * len(langs) * np.eye(x.shape[1]) / x.shape[1], x.T @ y)
    weights = np.zeros((1 << bits, len(labels)), np.float32)
    weights[places] = presence @ (half @ ridge).astype(np.float32)
    return Model(labels, weights)


def sample(docs: DataFrame, chosen: Column) -> tuple[list[str], list[str]]:
    """About rows_for labelled rows of each language, one at least: those whose hash is least."""
    short = F.length("text") <= MOST_CHARS
    rows = docs.filter(chosen & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", short.alias("short"), F.xxhash64(F.lit(7), "doc_id", "text").alias("h"))
    counts = rows.groupBy("lang", "short").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    if not counts:
        return [], []
    use = {r["lang"]: r for r in sorted(counts, key=lambda r: r["short"])}  # short ones where there are any
    most = rows_for(len(use))
    shares = [(k, r["short"], min(1.0, 1.5 * most / r["n"]), r["least"]) for k, r in use.items()]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, short boolean, share double, least long")
    place = F.pmod("h", F.lit(1 << 20)) / float(1 << 20)
    got = rows.join(F.broadcast(shares), ["lang", "short"]).filter((place < F.col("share")) | (F.col("h") == F.col("least")))
    part = F.when(F.col("short"), F.col("text")).otherwise(F.expr(f"substring(text, regexp_instr(text, '\\\\p{{L}}'), {MOST_CHARS})"))
    got = got.select("lang", "h", part.alias("text")).dropDuplicates(["lang", "h"])
    first = Window.partitionBy("lang").orderBy("h")
    got = got.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= most).select("h", "lang", "text").collect()
    got = sorted((r for r in got if any(map(str.isalpha, r["text"]))), key=lambda r: (r["h"], r["lang"]))
    return [r["text"] for r in got], [r["lang"] for r in got]


def learned(docs: DataFrame, held_out: Column | None = None) -> Model:
    """A model of the labelled rows that are not held out (default: crc32 of the id mod 4 is 2)."""
    held_out = remainder(F.col("doc_id"), 4) == 2 if held_out is None else held_out
    kinds = {"doc_id": "long", "text": "string", "lang": "string"}
    model = fit(*sample(docs.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]), ~held_out))
    trim()
    return model


def identify(docs: DataFrame, held_out: Column | None = None, known: Model | None = None) -> DataFrame:
    """The rows of docs with lang_pred string and score double after their own columns.

    held_out: rows that the fit must not see (default: crc32 of the id mod 4 is 2); known: a model
    to be used as it is. Only text is an input of a prediction. lang_pred is `und` with score 0
    where the text is null or has no letter, or where no labelled row exists; else score is the
    winner's regression value moved to 0..1; ties go to the language first by code point. Columns of
    docs that are called lang_pred or score are replaced. Only the sample is shuffled; the model has
    MOST_WEIGHTS weights up to 1024 languages, then 2**LEAST_BITS a language.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(known or learned(docs, held_out))
    docs = docs.drop("lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = model.value
        for texts in batches:
            ok = np.array([bool(m.labels) and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if ok.any():
                s = m.scores([t for t, k in zip(texts, ok) if k])
                pred[ok] = np.array(m.labels, object)[s.argmax(1)]
                score[ok] = np.clip((s.max(1).astype(float) + 1) / 2, 0, 1)
            yield pd.DataFrame({"lang_pred": pred, "score": score})
        trim()

    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(*own, predict(F.col("text").cast("string")).alias("found")).select(*own, "found.lang_pred", "found.score")


def confident(docs: DataFrame) -> DataFrame:
    """Pipeline filter: documents that the model takes for one of the languages it knows.

    Those without a letter go, and those whose score is below CONFIDENT: no language claims them.
    Where no language could be learned, every text with a letter stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows, known = docs.select("doc_id", "text", "lang", row), learned(docs)
    kept = identify(rows, known=known).filter(F.col("score") >= CONFIDENT) if known.labels else rows.filter(F.col("text").rlike(r"\p{L}"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
