"""Interpolated modified Kneser-Ney trigram model over all training texts.

Counting: tasks intern their words, sort their own trigrams and send them, packed, to the bucket of
their first two words; each bucket is merged by one task, so trigrams are combined before the
shuffle and a bucket is its share of the text, or the distinct followers of one pair if these are
more. A bucket then knows its pairs as contexts, and sends them on as events, with the number of
distinct words before; these buckets send on their words. All is one job. Storing: every merge
writes files of sorted hashes and counts to the shared folder. Scoring: workers memory-map the
files and look up a batch's distinct trigrams, pairs and words in order, in the buckets that they
fall into; scoring needs no shuffle.

Words are named by 48-bit hashes: of n distinct words about n * n / 2**49 pairs fall together, so
counts are exact up to some millions and off by 18 words of 10**8. Pairs and trigrams are named by
64-bit hashes of these, of which a table keeps so many bits that an unknown one is taken for a
known one with a chance of 3e-8. Files get a name of their
own for each attempt of a task, and one name a bucket is read, so lost executors do no harm.
"""

from __future__ import annotations

import functools
import mmap
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Scratch, remainder, small_batches

#: Bytes of text that make one bucket, and that are cut into words at once (a longer text alone), tokens that are counted or
#: scored at once, and that a task holds before it sorts them.
BUCKET_BYTES, TEXT_BYTES, PIECE, HELD = 18 << 20, 4 << 20, 1 << 18, 3 << 19
#: Most parts of the word table: the number of distinct words grows far slower than the text.
WORD_PARTS = 1024
#: Names of the place before a text and of its end, and their numbers.
MARKS, BEGIN, END = np.array([0x9E3779B97F4A, 0xC2B2AE3D27D4], np.uint64), 0, 1
#: Common words, which are sent as numbers that hold for the whole job, and documents (about) that a look for them reads:
#: they decide how rows are packed, not what is counted.
COMMON, LOOKED_AT = 49_152, 4000
#: Names that a key of three numbers has room for.
RADIX = 1 << 21


def tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(from, to, ids, owner, names) of runs of texts: ids are places among names, BEGIN twice before each text's words and
    END after them; owner is each id's text. Null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TEXT_BYTES, "right")))
        # A-Z lower-cased, cut at runs of the blank and the controls tab to carriage return
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts[at:to]))
        words = parts.flatten().dictionary_encode()
        own, n = words.indices.to_numpy(zero_copy_only=False), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        who = np.repeat(np.arange(to - at), n)
        listed = words.dictionary.cast(pa.large_binary()).to_pylist()
        if b"" in listed:  # beside leading and trailing blanks
            some = own != listed.index(b"")
            own, who = own[some], who[some]
            n = np.bincount(who, minlength=to - at)
        names = np.concatenate([MARKS, np.fromiter((xxhash.xxh3_64_intdigest(w) >> 16 for w in listed), np.uint64, len(listed))])
        end = np.cumsum(n + 3)
        ids = np.full(int(end[-1]), BEGIN, np.int32)
        ids[end - 1] = END
        ids[np.arange(len(own)) + 3 * who + 2] = own + 2
        yield at, to, ids, np.repeat(np.arange(to - at), n + 3), names
        at = to


def mixed(a: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence and of one word more."""
    return mixed(mixed(before) * np.uint64(3) + word)


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and where in it each distinct key begins."""
    order = np.argsort(key)
    key = key[order]
    return order, np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def distinct(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def summed(key: np.ndarray, *numbers: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Place of a row of each distinct key, in the order of keys, and numbers added up."""
    order, first = grouped(key)
    return order[first], [np.add.reduceat(n[order], first, dtype=np.int64) if len(key) else n for n in numbers]


def planes(a: np.ndarray, size: int) -> bytes:
    """Numbers byte by byte: all lowest ones first."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unplaned(raw: bytes, n: int, size: int, at: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T
    return out.reshape(-1).view("<u8")


def packed(names: np.ndarray, common: int, columns: list[np.ndarray], sums: np.ndarray) -> bytes:
    """Rows in the order of their columns, compressed: the names that they use beyond the common ones, sorted, as differences;
    columns as places among common and these names, the first two as differences; numbers as a byte each and those over 254
    apart."""
    used = np.zeros(len(names), bool)
    for c in columns:
        used[c] = True
    own = np.flatnonzero(used[common:]) + common
    own = own[np.argsort(names[own])]
    rank = np.arange(len(names))
    rank[own] = common + np.arange(len(own))
    size = 2 if common + len(own) <= 1 << 16 else 3
    columns = [rank[c] for c in columns]
    order = np.argsort(columns[0] << 32 | columns[1] if len(columns) > 1 else columns[0])
    columns, sums = [c[order] for c in columns], sums[:, order]
    columns[:2] = [np.diff(c, prepend=0) for c in columns[:2]]  # of the second, modulo its bytes
    body = [planes(np.diff(names[own], prepend=np.uint64(0)), 6), *(planes(c, size) for c in columns), np.minimum(sums, 255).astype(np.uint8).tobytes(), sums[sums > 254].astype("<i8").tobytes()]
    return np.array([len(own), size, len(order), len(columns), len(sums)], "<i8").tobytes() + zstandard.compress(b"".join(body), 1)


def unpacked(b: bytes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Names beyond the common ones, columns of places among both, numbers."""
    own, size, n, width, rows = np.frombuffer(b, "<i8", 5).tolist()
    raw = zstandard.decompress(b[40:])
    names, at = np.cumsum(unplaned(raw, own, 6, 0)), 6 * own
    columns = [unplaned(raw, n, size, at + i * n * size).astype(np.int64) for i in range(width)]
    columns[:2] = [np.cumsum(c) & (256**size - 1) for c in columns[:2]]
    at += width * n * size
    sums = np.frombuffer(raw, np.uint8, rows * n, at).astype(np.int64)
    sums[sums == 255] = np.frombuffer(raw, "<i8", offset=at + rows * n)
    return names, columns, sums.reshape(rows, n)


def dealt(to: np.ndarray, names: np.ndarray, common: int, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed rows) of each bucket that has any."""
    order = np.argsort(to.astype(np.uint16) if len(to) and to.max() < 1 << 16 else to, kind="stable")
    found, first = np.unique(to[order], return_index=True)
    for k, i in zip(found.tolist(), np.split(order, first[1:])):
        yield k, packed(names, common, [c[i] for c in columns], sums[:, i])


def numbered(names: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names after the common ones, and the place of each name among both."""
    order = np.argsort(common, kind="stable")
    at = np.minimum(np.searchsorted(common, names, sorter=order), len(common) - 1)
    known = common[order[at]] == names
    rest = distinct(names[~known])
    out = np.where(known, order[at], 0)
    out[~known] = len(common) + np.searchsorted(rest, names[~known])
    return np.concatenate([common, rest]), out


def counted(texts: Iterator[pa.Array], buckets: int, common: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed rows): distinct trigrams of some HELD tokens with their counts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> Iterator[tuple[int, bytes]]:
        names, at = numbered(np.concatenate([n for n, _ in held]), common)
        keys, first = [], 0
        for own, ids in held:
            a = at[first : first + len(own)][ids]
            first += len(own)
            keys.append(((a[:-2] * RADIX + a[1:-1]) * RADIX + a[2:])[a[2:] != BEGIN])
        held.clear()
        key = np.sort(np.concatenate(keys))
        if not len(key):
            return
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n, key = np.diff(first, append=len(key)), key[first]
        u, v, w = (x.astype(np.int32) for x in (key // (RADIX * RADIX), key // RADIX % RADIX, key % RADIX))
        del keys, key, first
        pa.default_memory_pool().release_unused()
        yield from dealt(joined(names[u], names[v]) % np.uint64(buckets), names, len(common), [u, v, w], n[None])

    for some in texts:
        for _, _, ids, _, names in tokens(some):
            for at in range(0, len(ids) - 2, PIECE):  # each piece after the two words before it
                piece = ids[at : at + PIECE + 2]
                used = np.zeros(len(names), bool)
                used[piece] = True
                if held and (sum(len(x) for _, x in held) > HELD or sum(len(x) for x, _ in held) + used.sum() + len(common) > RADIX):
                    yield from out()
                held.append((names[used], (np.cumsum(used) - 1)[piece]))
    if held:
        yield from out()


class Table:
    """A file of sorted hashes, each with some numbers.

    Of a hash the upper bits are an index into the file, so about 16 share them, and the next 29 are
    kept with the number of the row's numbers among the 7 most frequent rows. Other rows stand apart
    in the order of their places, a byte a number, and numbers over 254 apart once more.
    """

    def __init__(self, data: bytes | mmap.mmap):
        n, self.width, self.bits, apart, wide = np.frombuffer(data, "<i8", 5).tolist()
        at = 40

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.book = part("<i8", 8 * self.width).reshape(8, self.width)
        self.spot, self.value = part("<i8", wide), part("<i8", wide)
        self.start, self.rest, self.place = part("<u4", (1 << self.bits) + 1), part("<u4", n), part("<u4", apart)
        self.cell = part("u1", apart * self.width).reshape(apart, self.width)

    @staticmethod
    def split(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        upper = h >> np.uint64(64 - bits) if bits else np.zeros(len(h), np.uint64)
        return upper.astype(np.int64), (h >> np.uint64(35 - bits)).astype(np.uint32) & np.uint32((1 << 29) - 1)

    @staticmethod
    def parts(h: np.ndarray, sums: np.ndarray) -> Iterator[bytes]:
        """The file of sorted hashes and of sums, a row for each number."""
        bits, rows = max(0, min(24, len(h).bit_length() - 5)), np.ascontiguousarray(sums.T.astype(np.int64))
        key = functools.reduce(joined, rows.T.astype(np.uint64))
        _, first, same, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        most = np.argsort(-times, kind="stable")[:7]
        code = np.full(len(first), 7, np.uint32)
        code[most] = np.arange(len(most))
        code, book = code[same], np.zeros((8, len(sums)), np.int64)
        book[: len(most)] = rows[first[most]]
        place = np.flatnonzero(code == 7)
        flat = rows[place].reshape(-1)
        spot = np.flatnonzero(flat > 254)
        upper, rest = Table.split(h, bits)
        yield np.array([len(h), len(sums), bits, len(place), len(spot)], "<i8").tobytes() + book.tobytes() + spot.astype("<i8").tobytes() + flat[spot].tobytes()
        yield np.searchsorted(upper, np.arange((1 << bits) + 1)).astype("<u4").tobytes()
        yield (rest << np.uint32(3) | code).astype("<u4").tobytes()
        yield place.astype("<u4").tobytes() + np.minimum(flat, 255).astype(np.uint8).tobytes()

    def of(self, h: np.ndarray) -> np.ndarray:
        """A row of numbers for each hash; zeros where unknown."""
        out = np.zeros((len(h), self.width), np.int64)
        if not len(self.rest):
            return out
        upper, rest = self.split(h, self.bits)
        lo, hi = self.start[upper].astype(np.int64), self.start[upper + 1].astype(np.int64)
        end, last, want = hi.copy(), len(self.rest) - 1, rest << np.uint32(3)
        for _ in range(int((hi - lo).max(initial=0)).bit_length()):  # least place that is not smaller
            mid = (lo + hi) >> 1
            less = (self.rest[np.minimum(mid, last)] < want) & (lo < hi)
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
        found = self.rest[np.minimum(lo, last)]
        hit = np.flatnonzero((lo < end) & (found >> np.uint32(3) == rest))
        code = found[hit] & np.uint32(7)
        out[hit] = self.book[code]
        if len(far := hit[code == 7]):
            at = np.searchsorted(self.place, lo[far])
            got = self.cell[at].astype(np.int64)
            i, j = np.nonzero(got == 255)
            got[i, j] = self.value[np.searchsorted(self.spot, at[i] * self.width + j)]
            out[far] = got
        return out


def store(folder: str, h: np.ndarray, sums: np.ndarray) -> str:
    """Writes a table; its path."""
    fs, at = pafs.FileSystem.from_uri(folder)
    fs.create_dir(at, recursive=True)
    name = uuid.uuid4().hex
    with fs.open_output_stream(f"{at}/{name}") as f:
        for part in Table.parts(h, sums):
            f.write(part)
    return f"{folder}/{name}"


@functools.lru_cache(maxsize=4096)
def mapped(path: str) -> Table:
    """The file memory-mapped; one of a remote store is copied to a nameless local file first."""
    fs, at = pafs.FileSystem.from_uri(path)
    if isinstance(fs, pafs.LocalFileSystem):
        f = open(at, "rb")  # noqa: SIM115
    else:
        f = tempfile.TemporaryFile()  # noqa: SIM115
        with fs.open_input_stream(at) as source:
            while some := source.read(1 << 22):
                f.write(some)
        f.flush()
    with f:
        return Table(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


#: What a merge passes on: packed rows for a bucket of the next, or (bucket -1) a file that it has written and its totals.
STEP = "bucket long, rows binary, level int, number long, path string, tops array<long>"


def few(n: np.ndarray) -> list[np.ndarray]:
    """Whether each number is 1, 2, more."""
    return [n == 1, n == 2, n > 2]


def counts_of(n: np.ndarray) -> list[int]:
    """How many numbers are 1, 2, 3, 4."""
    return [int((n == i).sum()) for i in (1, 2, 3, 4)]


class Merge:
    """Merges the rows of each bucket: stores tables, sends rows to buckets of the next merge."""

    def __init__(self, folder: str, buckets: int, common: Callable[[], np.ndarray]):
        self.folder, self.buckets, self.common = folder, buckets, common

    def file(self, level: int, k: int, h: np.ndarray, sums: np.ndarray, tops: list[int]) -> tuple:
        return -1, None, level, k, store(self.folder, h, sums), tops

    def sent(self, to: np.ndarray, names: np.ndarray, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[tuple]:
        return ((i, rows, None, None, None, None) for i, rows in dealt(to, names, len(self.common()), columns, sums))

    def bucket(self, k: int, names: np.ndarray, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[tuple]:
        raise NotImplementedError

    def done(self, k: int, held: list[bytes]) -> Iterator[pd.DataFrame]:
        parts = [unpacked(b) for b in held]
        held.clear()
        names = distinct(np.concatenate([p[0] for p in parts]))
        common = self.common()
        at = [np.concatenate([np.arange(len(common)), len(common) + np.searchsorted(names, p[0])]) for p in parts]
        names = np.concatenate([common, names])
        columns = [np.concatenate([a[p[1][i]] for a, p in zip(at, parts)]).astype(np.int32) for i in range(len(parts[0][1]))]
        sums = np.concatenate([p[2] for p in parts], 1)
        del parts
        out = []
        for row in self.bucket(k, names, columns, sums):
            out.append(row)
            if len(out) == 16:
                yield pd.DataFrame(out, columns=COLUMNS)
                out = []
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = -1, []
        for batch in batches:
            earlier = batch[batch["bucket"] < 0]  # files of the merges before
            if len(earlier):
                yield earlier.reindex(columns=COLUMNS)
            for k, b in zip(batch["bucket"], batch["rows"]):
                if k >= 0:
                    if k != now and held:
                        yield from self.done(now, held)
                    now = k
                    held.append(b)
        if held:
            yield from self.done(now, held)


COLUMNS = [c.split()[0] for c in STEP.split(", ")]


class Trigrams(Merge):
    """Level 0: trigrams with counts. Level 1: their first two words as contexts: sum, and how many occur once, twice, more.
    On go their last two as events: number of distinct words before, and occurrences."""

    def bucket(self, k: int, names: np.ndarray, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[tuple]:
        h = joined(joined(names[columns[0]], names[columns[1]]), names[columns[2]])
        first, (n,) = summed(h, sums[0])
        u, v, w = (c[first] for c in columns)
        h = h[first]
        columns.clear()
        yield self.file(0, k, h, n[None], counts_of(n))
        context = joined(names[u], names[v])
        at, own = summed(context, n, *few(n))
        yield self.file(1, k, context[at], np.stack(own), [])
        del h, u, context
        event = joined(names[v], names[w])
        at, own = summed(event, np.ones(len(n), np.int64), n)
        yield from self.sent(event[at] % np.uint64(self.buckets), names, [v[at], w[at]], np.stack(own))


class Pairs(Merge):
    """Level 2: pairs as events: number of distinct words before, at the begin of texts occurrences. On go words: occurrences
    and number of distinct words before; as context the sum of its events' numbers and how many of these are 1, 2, more."""

    def bucket(self, k: int, names: np.ndarray, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[tuple]:
        pair = joined(names[columns[0]], names[columns[1]])
        first, (n, raw) = summed(pair, *sums)
        x, y = (c[first] for c in columns)
        columns.clear()
        n = np.where(names[x] == MARKS[BEGIN], raw, n)
        yield self.file(2, k, pair[first], n[None], counts_of(n))
        each = lambda at, weight=None: np.bincount(at, weight, len(names)).astype(np.int64)
        own = np.stack([each(y, raw), each(y), each(x, n), *(each(x[i]) for i in few(n))])
        word = np.flatnonzero(own.any(0))
        yield from self.sent(mixed(names[word]) % np.uint64(self.buckets), names, [word], own[:, word])


class Unigrams(Merge):
    """Level 3: words, six numbers each, with what they add up to."""

    def bucket(self, k: int, names: np.ndarray, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[tuple]:
        word = mixed(names[columns[0]])
        first, s = summed(word, *sums)
        s = np.stack(s)
        tops = [*counts_of(s[1]), int(s[1].sum()), int(s[0].sum()), int((s[0] > 0).sum()), *(int(x.sum()) for x in few(s[1]))]
        yield self.file(3, k, word[first], s, tops)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """For counts 0, 1, 2 and more (modified Kneser-Ney); each at most its count and above 0."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(float(np.clip(x, 0.05, i + 0.95)) for i, x in enumerate(d))])


class Model:
    """The places of the tables, a path a bucket, and a few totals."""

    def __init__(self, buckets: list[int], files: list):
        self.buckets, self.paths = buckets, [{}, {}, {}, {}]
        tops: list[list[int]] = [[0] * 10 for _ in range(4)]
        for r in files:
            if r["number"] not in self.paths[r["level"]]:  # a task that ran twice may have told of two
                self.paths[r["level"]][r["number"]] = r["path"]
                for i, n in enumerate(r["tops"]):
                    tops[r["level"]][i] += n
        self.d3, self.d2, self.d1 = (discounts(*tops[i][:4]) for i in (0, 2, 3))
        self.types, self.tokens, self.distinct = tops[3][4:7]
        self.left = float(np.dot(tops[3][7:10], self.d1[1:]))

    def numbers(self, level: int, h: np.ndarray, to: np.ndarray, width: int) -> np.ndarray:
        """Of each hash its numbers; only buckets that some hash falls into are opened."""
        order = np.argsort(to.astype(np.uint16) if self.buckets[0] <= 1 << 16 else to, kind="stable")
        found, first = np.unique(to[order], return_index=True)
        out = np.zeros((len(h), width), np.int64)
        for k, i in zip(found.tolist(), np.split(order, first[1:])):
            if path := self.paths[level].get(k):
                out[i] = mapped(path).of(h[i])
        return out

    def score(self, ids: np.ndarray, names: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words at here + 2, each after the two before it: occurrences, base log probability, log probability.

        ids: a sequence of places among names.
        """
        used = np.zeros(len(names), np.int64)
        used[ids] = 1
        own = mixed(names[used > 0])
        word = self.numbers(3, own, own % np.uint64(self.buckets[2]), 6)
        at = (np.cumsum(used) - 1)[ids]
        before, last = word[at[here + 1]], word[at[here + 2]]
        h = names[ids]
        pair = joined(h[:-1], h[1:])
        own, at = np.unique(pair, return_inverse=True)
        to = own % np.uint64(self.buckets[0])
        above, event = self.numbers(1, own, to, 4)[at[here]], self.numbers(2, own, to, 1)[at[here + 1], 0]
        n = self.numbers(0, joined(pair[here], h[here + 2]), to[at[here]], 1)[:, 0]

        def level(count: np.ndarray, d: np.ndarray, total: np.ndarray, kinds: np.ndarray, lower: np.ndarray) -> np.ndarray:
            return np.where(total > 0, (np.maximum(count - d[np.minimum(count, 3)], 0) + (kinds @ d[1:]) * lower) / np.maximum(total, 1), lower)

        types = max(1, self.types)
        p = np.maximum(last[:, 1] - self.d1[np.minimum(last[:, 1], 3)], 0) / types + (self.left / types if self.types else 1.0) / (self.distinct + 1)
        p = level(event, self.d2, before[:, 2], before[:, 3:], p)
        p = level(n, self.d3, above[:, 0], above[:, 1:], p)
        base = np.log10((last[:, 0] + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))
        return last[:, 0], base, np.log10(p)


def common_names(texts: DataFrame, n: int) -> np.ndarray:
    """The marks, and the names of the most frequent words of a few documents, the most frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, ids, _, names in tokens(batch.column(0)):
                uses = np.bincount(ids, minlength=len(names))[2:]
                yield pa.RecordBatch.from_arrays([pa.array(names[2:].astype(np.int64)), pa.array(uses)], ["name", "n"])

    some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, LOOKED_AT / max(1, n)) * (1 << 30)))
    top = some.select("text").mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1")
    return np.array([*MARKS, *(r["name"] for r in top.orderBy(F.desc("n"), "name").limit(COMMON).collect())], np.uint64)


def train(texts: DataFrame, scratch: Scratch) -> Model:
    """A model of all texts (column text) of the DataFrame."""
    spark = texts.sparkSession
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(1, -(-size // BUCKET_BYTES))
    common = spark.sparkContext.broadcast(common_names(texts, n))
    shared = functools.partial(_value, common)
    numbers, folder = [buckets, buckets, max(1, min(WORD_PARTS, buckets // 4))], f"{scratch.root}/model"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in counted((b.column(0) for b in batches), buckets, common.value):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([rows], pa.binary())], ["bucket", "rows"])

    rows = texts.select("text").mapInArrow(count, "bucket long, rows binary")
    for n, merge in zip(numbers, (Trigrams(folder, numbers[1], shared), Pairs(folder, numbers[2], shared), Unigrams(folder, 1, shared))):
        # files that are told of have bucket -1 and come first
        rows = rows.repartitionById(n, F.greatest("bucket", F.lit(0)).cast("int")).sortWithinPartitions("bucket").mapInPandas(merge, STEP)
    return Model(numbers, rows.select("level", "number", "path", "tops").collect())


def _value(broadcast: Any) -> Any:
    return broadcast.value


def score(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Learns from the rows that are not held out (default: crc32 of the id mod 5 is 1) and scores
    all. A null or blank text is the end token alone. With nothing to learn from, every token has
    the probability of the unknown one. Repeated rows count and score as often as they stand.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    small_batches(spark)
    held_out = remainder(F.col("doc_id"), 5) == 1 if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(rows.filter(~held_out), scratch)
    total, shared = model.tokens, spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = np.zeros((4, batch.num_rows))
            for first, to, ids, owner, names in tokens(batch.column("text")):
                for at in range(0, len(ids) - 2, PIECE):  # each piece after the two words before it
                    piece, who = ids[at : at + PIECE + 2], owner[at : at + PIECE + 2]
                    here = np.flatnonzero(piece[2:] != BEGIN)
                    raw, base, p = shared.value.score(piece, names, here)
                    for i, x in enumerate((np.ones(len(here)), raw > 0, base, p)):
                        sums[i, first:to] += np.bincount(who[here + 2], x, to - first)
            n = sums[0].astype(np.int64)
            arrays = [batch.column("doc_id"), batch.column("held_out"), *map(pa.array, (n, sums[1].astype(np.int64), np.full(len(n), total), sums[2], sums[3], 10 ** (-sums[3] / n)))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return rows.withColumn("held_out", held_out).mapInArrow(run, schema)
