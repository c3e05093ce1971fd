"""BPE encoding and decoding by a trie of distinct words.

For byte-pair encoding the encoding of a word's prefix is the encoding of a shorter prefix plus
one last token, and that token is the only one that is valid after the shorter prefix's own last
token. Words are visited in byte order, which is the depth-first order of their trie: the states
on the path that a word shares with its predecessor are kept, so shared prefixes are computed once.
The more words are in one trie, the more they share: words of a whole batch are numbered first, new
ones go through one trie together, and texts are put together by numbers.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import small_batches, trim

#: Fixed value: the byte-level tokenizer's own split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a worker remembers from batch to batch and new ones that it takes up at once (about), and
#: pairs of tokens that it remembers, at most; beyond it they are computed anew.
MOST_WORDS, MOST_PAIRS = 120_000, 1_000_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Numbers(dict):
    """Words' numbers, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class TrieEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.ids = {raw(k): v for k, v in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for k, v in self.ids.items():
            self.tokens[v] = k
        for k, v in self.special.items():
            self.tokens[v] = k.encode()
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.longest = max(map(len, self.ids))
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        """Forgets all words. known: the ids of the words that have a number, by number."""
        self.numbers, self.known = Numbers(), []

    def plain(self, word: bytes) -> list[int]:
        """The definition: merge the neighbours of least rank until none can merge."""
        ids = [self.ids[word[i : i + 1]] for i in range(len(word))]
        while len(ids) > 1:
            rank, new, i = min((*self.merges.get(p, (1 << 60, -1)), i) for i, p in enumerate(zip(ids, ids[1:])))
            if new < 0:
                break
            ids[i : i + 2] = [new]
        return ids

    def follows(self, a: int, b: int) -> bool:
        if (out := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            out = self.pairs[a, b] = self.plain(self.tokens[a] + self.tokens[b]) == [a, b]
        return out

    def single(self, a: int) -> bool:
        if (out := self.whole.get(a)) is None:
            out = self.whole[a] = self.plain(self.tokens[a]) == [a]
        return out

    def trie(self, ordered: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Words in byte order, each with its ids. last[i]: the token that ends the prefix of i bytes."""
        last, before, ids, longest, pairs = [-1], b"", self.ids, self.longest, self.pairs
        for word in ordered:
            keep = len(os.path.commonprefix((before, word)))
            del last[keep + 1 :]
            for end in range(keep + 1, len(word) + 1):
                for start in range(end - longest if end > longest else 0, end):
                    if (t := ids.get(word[start:end])) is not None:
                        if start:
                            ok = pairs.get((last[start], t))
                            ok = self.follows(last[start], t) if ok is None else ok
                        else:
                            ok = self.single(t)
                        if ok:
                            last.append(t)
                            break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            out, end = [], len(word)
            while end:
                out.append(last[end])
                end -= len(self.tokens[last[end]])
            yield word, out[::-1]
            before = word

    def pieces(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special tokens, which stand for themselves (True)."""
        out, at = [], 0
        for m in self.cut.finditer(text) if self.cut else ():
            out += [(text[at : m.start()], False), (m[0], True)]
            at = m.end()
        return [x for x in [*out, (text[at:], False)] if x[0]]

    def learn(self) -> None:
        """One trie for the words that have a number but no ids yet."""
        new = {w.encode(): i for w, i in itertools.islice(self.numbers.items(), len(self.known), None)}
        self.known += [b""] * len(new)
        for word, ids in self.trie(sorted(new)):
            self.known[new[word]] = struct.pack(f"<{len(ids)}I", *ids)

    def forget(self, seen: list[np.ndarray]) -> None:
        """Beyond MOST_WORDS only words stay that the texts seen last hold more than once: the rest seldom comes again."""
        if len(self.known) <= MOST_WORDS:
            return
        again = np.bincount(np.concatenate(seen), minlength=len(self.known)) > 1
        words, known, self.numbers = list(self.numbers), self.known, Numbers()
        stay = np.flatnonzero(again)[:MOST_WORDS].tolist()
        self.numbers.update((words[i], at) for at, i in enumerate(stay))
        self.known = [known[i] for i in stay]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = []
        waiting: list[tuple[list[bytes], int, np.ndarray]] = []  # numbers of words, and where their ids go

        def settle() -> None:
            self.learn()
            for parts, at, numbers in waiting:
                parts[at] = b"".join(map(self.known.__getitem__, numbers.tolist()))
            self.forget([numbers for _, _, numbers in waiting])
            waiting.clear()

        for text in texts:
            out.append(parts := [])
            for part, special in self.pieces(text):
                if special:
                    parts.append(struct.pack("<I", self.special[part]))
                    continue
                found = self.split(part)
                for at in range(0, len(found), MOST_WORDS):  # a text may have more words than may be remembered
                    some = found[at : at + MOST_WORDS]
                    waiting.append((parts, len(parts), np.fromiter(map(self.numbers.__getitem__, some), np.int32, len(some))))
                    parts.append(b"")
                    if len(self.numbers) - len(self.known) > MOST_WORDS:
                        settle()
        if waiting:
            settle()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.cache
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian u32), decoded, ids_sha256, decoded_sha256 per row.

    path: the tokenizer's file, at the same place on every machine. A null text is an empty one
    and has no ids; rows with equal or null doc_id each give a row; other columns are not read.
    No shuffle: memory is one Arrow batch and three times MOST_WORDS words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            rows = [(ids, enc.decode(ids)) for ids in enc.encode(texts)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n_tokens": [len(i) // 4 for i, _ in rows], "ids": [i for i, _ in rows], "decoded": [d for _, d in rows],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i, _ in rows], "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, d in rows],
            })
        enc.clear()  # the worker may serve other operators next
        trim()

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "doc_id long, n_tokens long, ids binary, decoded string, ids_sha256 string, decoded_sha256 string")
