"""Main text of pages by consensus paths of their host.

Each page's elements are scored by the text that they hold outside links and page furniture, and
vote for the generalised tag-class path of the best container (classes sorted, digits levelled):
the innermost one that leaves nothing but furniture and lines of links outside. Furniture is what
tags say for certain, and what words of classes say, unless next to all of a page's text is there.
Spark adds up the votes of each host; then every page is extracted anew from the elements on its
host's winning path if they hold all that the page's own best one holds, else from that one.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, small_batches, spread_join
from .urlfilter import host_of

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")
NO_LETTER = re.compile(r"[\W_]+")

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe xmp noembed noframes".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = set("body main article section div td center blockquote details".split())
SKIP = set("head nav header footer aside form button select input textarea script style noscript template iframe svg math canvas object audio video dialog menu title datalist".split())
#: Words of class, id and role that mark what is not the article.
NOISE = set("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored notice cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription comment comments respond disqus share sharing social related recommended login signup search widget toolbar pager pagination contentinfo complementary alert dialog".split())
#: Of these, words of what is never the article, however much of a page it is.
NEVER = set("comment comments respond disqus cookie cookies consent gdpr advert adverts advertisement".split())
#: A class that begins or ends so says what its element has or allows, not what it is.
ABOUT, STATE = set("has with no without not".split()), set("open closed enabled disabled".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements whose open one ends where one of the same group begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WALLS = set("ul ol dl table article section div body main td th blockquote".split())


@functools.lru_cache(1 << 16)
def path_id(above: int, step: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{above:x}/{step}") >> 1


class Page:
    """A page as lists: of each element its parent, tag, generalised path (63 bits that name it), whether it is furniture;
    pieces of text in order. Time and memory grow with the page, not with its depth."""

    def __init__(self, html: str):
        self.parent, self.tag, self.path = [-1], ["#"], [0]
        self.sure, self.marked, self.never = [False], [False], [False]  # by tag or style, by a class, by one that is never spared
        self.pieces: list[tuple[int, str | None]] = []  # None: a block begins or ends
        self.opened: Counter[str] = Counter()
        stack, at = [0], 0
        while m := TOKEN.search(html, at):
            if m.start() > at:
                self.pieces.append((stack[-1], unescape(html[at : m.start()])))
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self.pieces.append((stack[-1], m[0][9:].removesuffix("]]>")))
                continue
            if m[1] or m[4]:
                self.close(stack, name)
                continue
            self.open(stack, name, m[3] or m[6] or "")
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
                self.cut(stack, len(stack) - 1)
        if at < len(html):
            self.pieces.append((stack[-1], unescape(html[at:])))
        self.noise = self.furniture(set())
        self.spare()

    def cut(self, stack: list[int], at: int) -> None:
        for i in stack[at:]:
            self.opened[self.tag[i]] -= 1
        del stack[at:]

    def innermost(self, stack: list[int], tags: set[str], walls: set[str]) -> int:
        """Place of the innermost open element with one of the tags, if no wall stands below it; else 0."""
        if any(self.opened[t] for t in tags):
            for i in range(len(stack) - 1, 0, -1):
                if (tag := self.tag[stack[i]]) in tags:
                    return i
                if tag in walls:
                    break
        return 0

    def open(self, stack: list[int], name: str, attributes: str) -> None:
        if name == "br":
            self.pieces.append((stack[-1], " "))
            return
        if name in BLOCKS:
            if p := self.innermost(stack, {"p"}, WALLS):
                self.cut(stack, p)
            if name in ENDS:
                ends = ENDS[name]
                if p := self.innermost(stack, ends, WALLS - {"td", "th"} if name == "tr" else WALLS - ends):
                    while p > 1 and self.tag[stack[p - 1]] in ends:
                        p -= 1
                    self.cut(stack, p)
            self.pieces.append((stack[-1], None))
        found = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        if not found:
            return self.add(stack, name, name, name in SKIP, set())
        classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in found.get("class", "").split()})
        words: set[str] = set()
        for k in ("class", "id", "role"):
            for label in found.get(k, "").split():
                own = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", label).lower()) if x]
                if own and not (len(own) > 1 and (own[0] in ABOUT or own[-1] in STATE)):
                    words.update(own)
        sure = name in SKIP or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        self.add(stack, name, ".".join([name, *classes]), sure, words)

    def add(self, stack: list[int], name: str, step: str, sure: bool, words: set[str]) -> None:
        parent, body = stack[-1], name in ("html", "body", "article", "main")
        self.parent.append(parent)
        self.tag.append(name)
        self.path.append(path_id(self.path[parent], step))
        self.sure.append(sure)
        self.marked.append(not body and not NOISE.isdisjoint(words))
        self.never.append(not body and not NEVER.isdisjoint(words))
        if name not in VOID:
            stack.append(len(self.tag) - 1)
            self.opened[name] += 1

    def furniture(self, spared: set[int]) -> list[bool]:
        """Whether each element is furniture. Of a header within an article or main its headings are not."""
        out, article, titles = [False], [False], [-1]  # titles: 1 + whether all above an article's header is furniture, else -1
        for i in range(1, len(self.tag)):
            p, name = self.parent[i], self.tag[i]
            article.append(article[p] or name in ("article", "main"))
            own = self.sure[i] or self.marked[i] and i not in spared
            if name == "header" and article[p] and not self.marked[i] and titles[p] < 0:
                titles.append(1 + out[p])
                out.append(True)
            elif titles[p] >= 0 and name in HEADINGS and not own:
                titles.append(-1)
                out.append(titles[p] == 2)
            else:
                titles.append(-1 if own else titles[p])
                out.append(own or out[p])
        return out

    def spare(self) -> None:
        """Elements that only words of classes mark are none if most of the page's text is in them and next to none outside."""
        if not any(self.marked):
            return
        outside = self.goods()[0]
        doubtful = {i for i, m in enumerate(self.marked) if m and not self.never[i] and not self.sure[i]}
        self.noise = self.furniture(doubtful)
        whole = self.goods()
        spared = {i for i in doubtful if 2 * whole[i] > whole[0] and 10 * outside < whole[i]}
        self.noise = self.furniture(spared)

    def close(self, stack: list[int], name: str) -> None:
        if self.opened[name]:
            i = next(i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == name)
            if name in BLOCKS:
                self.pieces.append((stack[i], None))
            self.cut(stack, i)
        elif name in BLOCKS:
            self.pieces.append((stack[-1], None))

    def goods(self) -> list[int]:
        """Characters of article text that each element holds: letters and digits outside furniture.

        A line counts unless most of it is link text; what links say in h1 and h2 counts as plain.
        """
        out = [0] * len(self.tag)
        linked, title = [t == "a" for t in self.tag], [t in ("h1", "h2") for t in self.tag]
        for i, p in enumerate(self.parent):
            title[i] = title[i] or p > 0 and title[p]
            linked[i] = linked[i] or p > 0 and linked[p]
        line: list[tuple[int, int]] = []
        for node, text in [*self.pieces, (0, None)]:
            if text is None:
                links = sum(n for i, n in line if linked[i] and not title[i])
                if 2 * links <= sum(n for _, n in line):
                    for i, n in line:
                        out[i] += n
                line = []
            elif not self.noise[node] and (n := len(NO_LETTER.sub("", text))):
                line.append((node, n))
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out

    def best(self) -> tuple[int, float]:
        """Path and score of the innermost container outside which only furniture and links stand."""
        good = self.goods()
        kids: dict[int, list[int]] = {}
        for i in range(1, len(self.tag)):
            kids.setdefault(self.parent[i], []).append(i)
        top, todo = 0, [0]
        while todo and good[0]:
            at = max(todo, key=lambda i: (good[i], -i))
            if good[at] < good[0] or self.noise[at]:
                break
            if self.tag[at] in CONTAINERS or top == 0:
                top = at
            if self.tag[at] == "article":
                break
            todo = kids.get(at, [])
        return self.path[top], float(good[top])

    def text(self, path: int) -> str:
        """Text of the elements on the path (the page if there are none), a line for each block."""
        inside = [False] * len(self.tag)
        whole = path not in self.path
        for i, p in enumerate(self.parent):
            inside[i] = whole or self.path[i] == path or p >= 0 and inside[p]
        lines, now = [], []
        for node, text in [*self.pieces, (0, None)]:
            if text is None:
                if line := SPACE.sub(" ", "".join(now)).strip():
                    lines.append(line)
                now = []
            elif inside[node] and not self.noise[node]:
                now.append(text)
        return "\n".join(lines)

    def main(self, path: int | None) -> str:
        own, score = self.best()
        if path is not None and path != own and path in self.path:
            good = self.goods()
            if sum(g for g, p, i in zip(good, self.path, self.parent) if p == path and (i < 0 or self.path[i] != path)) >= score:
                own = path
        return self.text(own)


def extract(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, text, n_chars.

    text: the article's blocks in order, one line each; empty for a null or empty html and where
    nothing but furniture stands. n_chars: its code points. Pages without a host (a null url, or
    one without ://) are a host together. Repeated rows and null ids each give a row.
    """
    scratch = Scratch(pages.sparkSession, "html")
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = [Page(h).best() if h else (0, 0.0) for h in batch["html"]]
            yield pd.DataFrame({"host": batch["host"], "path": [p for p, _ in best], "score": [s for _, s in best]})

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [Page(h).main(int(p) if isinstance(p, str) else None) if h else "" for h, p in zip(batch["html"], batch["path"])]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    votes = rows.select("host", "html").mapInPandas(vote, "host string, path long, score double").filter("score > 0")
    votes = votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    won = votes.groupBy("host").agg(F.max(F.struct("n", "score", "path")).alias("best")).select("host", F.col("best.path").alias("path"))
    won = scratch.table(won)
    both = spread_join(rows, won, "host", F.octet_length("host") + 48, F.struct("page_id", "url"))
    return both.withColumn("path", F.col("path").cast("string")).mapInPandas(again, "page_id long, url string, text string, n_chars long")
