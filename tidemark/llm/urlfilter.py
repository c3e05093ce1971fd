"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from a bounded sample of the URLs that rules decide, so what they say of the other
URLs is what the rules' verdicts show of paths, hosts and shapes. Statistics of suffixes leave out
those that a rule covers whole (its host and what lies below), and come from other folds of hosts
than the URL they describe, so a tree reads neither a rule nor a URL's own label in them. A URL is
blocked above a threshold that leaves alone nearly all URLs that the rules allow, each scored by
trees that have not seen its host. Judging needs the URL alone: one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules of the contract, as (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Bounds of the fit: labelled rows, trees, cuts on a path of a tree, share of each tree; folds of hosts; pseudo-count of statistics.
MOST_ROWS, TREES, DEPTH, RATE, FOLDS, PRIOR = 20_000, 60, 3, 0.2, 5, 2.0
#: Share of the allowed URLs of unseen hosts that may score above the threshold, which is one half at least.
LOST = 0.01
#: Names of the features, in order.
FEATURES = "length host_length depth digit_ratio entropy parameters hyphens labels secure host_digits tld_share tld_weight domain_share domain_weight part_share part_weight".split()


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits the host or a parent of it and the path's start."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def parts_of(url: str) -> tuple[str, str, str]:
    """Host, path and query of a lower-cased URL."""
    head = url.partition("://")[2].partition("#")[0]
    plain, _, query = head.partition("?")
    host, slash, path = plain.partition("/")
    return host, slash + path, query


def suffixes_of(url: str) -> tuple[str, str, str]:
    """What statistics are kept of: the host's last label, its last two, the path's first part."""
    host, path, _ = parts_of(url)
    labels = host.split(".")
    return labels[-1], ".".join(labels[-2:]), "/" + path[1:].partition("/")[0]


def fold_of(url: str) -> int:
    return xxhash.xxh3_64_intdigest(parts_of(url)[0].encode()) % FOLDS


class Suffixes:
    """Share and number of blocked URLs, in each fold of hosts, of each suffix that no rule's host covers."""

    def __init__(self, urls: list[str], y: np.ndarray, hosts: set[str]):
        self.found: dict[str, np.ndarray] = {}
        self.first = float(y.mean()) if len(y) else 0.5
        for url, v in zip(urls, y):
            u = url.lower()
            for s in set(suffixes_of(u)):
                if not s.startswith("/") and any(".".join(s.split(".")[i:]) in hosts for i in range(s.count(".") + 1)):
                    continue
                self.found.setdefault(s, np.zeros((FOLDS, 2)))[fold_of(u)] += (v, 1.0)

    def of(self, url: str, left_out: int | None) -> list[float]:
        """Smoothed share of blocked and log of the number, for each suffix; without one fold."""
        out = []
        for s in suffixes_of(url):
            blocked, n = 0.0, 0.0
            if (known := self.found.get(s)) is not None:
                blocked, n = known.sum(0) - (known[left_out] if left_out is not None else 0)
            out += [(blocked + PRIOR * self.first) / (n + PRIOR), float(np.log1p(n))]
        return out


def lexical(urls: Iterator[str | None], suffixes: Suffixes | None, own_fold: bool = False) -> np.ndarray:
    """A row of FEATURES for each URL. own_fold: statistics leave out the fold that the URL's host is in."""
    out = []
    for url in urls:
        u = (url or "").lower()
        host, path, query = parts_of(u)
        raw = u.encode("utf-8", "surrogatepass")
        n = np.unique(np.frombuffer(raw, np.uint8), return_counts=True)[1] / max(1, len(raw))
        statistics = suffixes.of(u, fold_of(u) if own_fold else None) if suffixes else [0.0] * 6
        out.append([len(u), len(host), path.count("/"), sum(map(str.isdigit, u)) / max(1, len(u)), -(n * np.log2(n)).sum() if len(n) else 0, query.count("=") + query.count("&"), host.count("-"), host.count(".") + 1, u.startswith("https"), sum(map(str.isdigit, host)), *statistics])
    return np.array(out, float).reshape(-1, len(FEATURES))


class Boosted:
    """Least-loss trees for the logistic loss on features cut at their quantiles."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T] if len(x) else []
        self.first = float(np.log(((weight * y).sum() + 1) / ((weight * (1 - y)).sum() + 1)))
        self.trees: list[list] = []
        b = self.binned(x)
        f = np.full(len(y), self.first)
        for _ in range(TREES if len(set(y.tolist())) > 1 else 0):
            p = 1 / (1 + np.exp(-f))
            tree: list = []
            self.grow(tree, b, weight * (y - p), weight * p * (1 - p), np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            f += self.walk(tree, b)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v) for c, v in zip(self.cuts, x.T)], 1) if self.cuts else np.zeros((len(x), 0), int)

    def grow(self, tree: list, b: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> int:
        at, (sum_g, sum_h) = len(tree), (g[rows].sum(), h[rows].sum())
        tree.append((-1, 0, 0, 0, RATE * sum_g / (sum_h + 1)))
        best = (1e-6, -1, 0)
        for k in range(b.shape[1] if depth else 0):
            gl, hl = (np.cumsum(np.bincount(b[rows, k], w[rows], 33))[:-1] for w in (g, h))
            gain = gl**2 / (hl + 1) + (sum_g - gl) ** 2 / (sum_h - hl + 1) - sum_g**2 / (sum_h + 1)
            i = int(gain.argmax())
            best = max(best, (float(gain[i]), k, i), key=lambda t: t[0])
        if best[1] >= 0:
            _, k, cut = best
            low = b[rows, k] <= cut
            if low.any() and not low.all():
                tree[at] = (k, cut, self.grow(tree, b, g, h, rows[low], depth - 1), self.grow(tree, b, g, h, rows[~low], depth - 1), 0.0)
        return at

    def walk(self, tree: list, b: np.ndarray) -> np.ndarray:
        at, out = np.zeros(len(b), int), np.array([t[4] for t in tree])
        k, cut, low, high = (np.array([t[i] for t in tree]) for i in range(4))
        for _ in range(DEPTH):
            inner = k[at] >= 0
            to = np.where(b[np.arange(len(b)), np.maximum(k[at], 0)] <= cut[at], low[at], high[at])
            at = np.where(inner, to, at)
        return out[at]

    def blocked(self, x: np.ndarray) -> np.ndarray:
        """Probability that a URL is to be blocked."""
        b = self.binned(x)
        f = np.full(len(x), self.first)
        for t in self.trees:
            f += self.walk(t, b)
        return 1 / (1 + np.exp(-f))


class Model:
    """Trees over the features of URLs, and a threshold; statistics may be left out, to see what they add.

    hosts: those of the rules, which decided the labels.
    """

    def __init__(self, urls: list[str], y: np.ndarray, hosts: set[str] = frozenset(), with_suffixes: bool = True):
        self.suffixes = Suffixes(urls, y, hosts) if with_suffixes else None
        x, fold = lexical(urls, self.suffixes, own_fold=True), np.array([fold_of(u.lower()) for u in urls], int)
        self.trees = self.fitted(x, y)
        unseen = np.zeros(len(y))
        for f in range(FOLDS):
            if (fold == f).any():
                unseen[fold == f] = self.fitted(x[fold != f], y[fold != f]).blocked(x[fold == f])
        allowed = np.sort(unseen[y == 0])
        self.threshold = max(0.5, float(allowed[min(len(allowed) - 1, int(len(allowed) * (1 - LOST)))]) if len(allowed) else 0.5)

    @staticmethod
    def fitted(x: np.ndarray, y: np.ndarray) -> Boosted:
        both = np.array([(y == 0).sum(), (y == 1).sum()])
        return Boosted(x, y, len(y) / 2 / np.maximum(both, 1)[y.astype(int)] if len(y) else np.zeros(0))  # both verdicts count alike

    def blocked(self, urls: Iterator[str | None]) -> np.ndarray:
        return self.trees.blocked(lexical(urls, self.suffixes))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, p_block.

    host and path are empty for a null url or one without ://. rule: the longest that fits the
    host or a parent domain and the start of the path, else null. verdict: the rule's, else block
    where p_block, the trees' probability, is over the model's threshold. Learns from about MOST_ROWS
    urls that rules decide (those of least hash); without any, or with one verdict alone, p_block is
    the same for all: all are blocked if all labelled ones are, else none. Repeated rows and null ids
    each give a row.
    """
    rules = RULES if rules is None else rules
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    ruled = rows.filter(F.col("fit").isNotNull() & F.col("url").isNotNull())
    place = F.pmod(F.xxhash64(F.lit(11), "url"), F.lit(1 << 20)) / float(1 << 20)
    got = ruled.filter(place < min(1.0, MOST_ROWS / max(1, ruled.count()))).select("url", "fit.verdict").orderBy(F.xxhash64("url"), "url").limit(2 * MOST_ROWS).collect()
    urls, y = [r["url"] for r in got], np.array([r["verdict"] == "block" for r in got], float)
    model = pages.sparkSession.sparkContext.broadcast(Model(urls, y, {h for _, h, _ in rules}))

    @F.pandas_udf("double")
    def p_block(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for u in batches:
            yield pd.Series(model.value.blocked(u))

    rows = rows.withColumn("p_block", p_block("url"))
    verdict = F.coalesce("fit.verdict", F.when(F.col("p_block") > model.value.threshold, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "p_block")
