"""Line dedup with DataFrame functions alone: suffix array over line ids by prefix doubling.

Only lines that stand more than once can be part of a repeated run; the others cut the documents
into segments. rank[j] orders the suffixes by their first 2**j lines: suffixes with an equal rank
are an interval of the suffix array whose longest common prefix has 2**j lines at least, and only
intervals of two or more go on, so each doubling joins fewer rows. The interval of any length L is
named by the ranks of its first and its last 2**j lines (2**j <= L). A run counts once it holds
`least` words; the shortest such run from every line on and up to every line are looked up, and a
line goes if one that covers it stands earlier too. Together they cover all maximal runs, since a
longer run is repeated exactly where all of those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Scratch, broadcast_if, ranked
from .mixing import word_count

KEY = ["d", "h"]


def lines_of(docs: DataFrame) -> DataFrame:
    """(d, h, pos, line, w): the non-blank lines, with their number in the document and their words."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    at = docs.select(d.alias("d"), F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "l"))
    at = at.filter(F.btrim("l", F.lit(" \t\n\x0b\x0c\r")) != "")
    return at.select("d", "h", "pos", F.xxhash64("l").alias("line"), word_count(F.col("l")).alias("w"))


def doubled(level: DataFrame, step: int, scratch: Scratch) -> DataFrame:
    """From ranks of runs of `step` lines to ranks of twice as many, of runs that repeat."""
    after = level.select(*KEY, (F.col("i") - step).alias("i"), F.col("r").alias("s"))
    pairs = scratch.table(level.join(after, [*KEY, "i"]))
    names = pairs.groupBy("r", "s").agg(F.count("*").alias("n")).filter("n > 1").select("r", "s")
    names = ranked(scratch, names, ["r", "s"], "rank")
    return scratch.table(pairs.join(names, ["r", "s"]).select(*KEY, "i", F.col("rank").alias("r")))


def repeated(docs: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """(d, h, gone): numbers (from 0) of the lines of each document that go."""
    lines = lines_of(docs)
    order = Window.partitionBy(*KEY).orderBy("pos")
    lines = scratch.table(lines)
    # written, so that a very common line is split among tasks by Spark's skewed join, which aggregations hide
    often = scratch.table(lines.groupBy("line").agg(F.count("*").alias("n")).filter("n > 1").select("line"))
    # blank lines do not count; a row that repeats doc_id and text is one document
    numbered = lines.distinct().withColumn("i", F.row_number().over(order).cast("long") - 1).join(often, "line")
    segment = Window.partitionBy(*KEY).orderBy("i")
    numbered = numbered.withColumn("seg", F.col("i") - F.row_number().over(segment))
    capped = F.least("w", F.lit(least))
    whole = Window.partitionBy(*KEY, "seg")
    upto = whole.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = numbered.withColumns({"all": F.sum(capped).over(whole), "ce": F.sum(capped).over(upto), "first": F.min("i").over(whole), "last": F.max("i").over(whole)})
    rows = rows.filter(F.col("all") >= least).withColumn("cs", F.col("ce") - capped)
    span = Window.partitionBy(*KEY, "seg")
    next_at = F.min("i").over(span.orderBy("cs").rangeBetween(least, 2 * least - 1))
    back_at = F.max("i").over(span.orderBy("ce").rangeBetween(1 - 2 * least, -least))
    end = F.when(next_at.isNotNull(), next_at).when(F.col("all") - F.col("cs") >= least, F.col("last") + 1)
    begin = F.when(back_at.isNotNull(), back_at + 1).when(F.col("ce") >= least, F.col("first"))
    rows = scratch.table(rows.select(*KEY, "i", "pos", "line", (end - F.col("i")).alias("ahead"), (F.col("i") - begin + 1).alias("back")))
    windows = rows.filter("ahead is not null").select(*KEY, "i", F.col("ahead").alias("n")).union(rows.filter("back is not null").select(*KEY, F.col("i") - F.col("back") + 1, "back")).distinct()
    windows = scratch.table(windows)
    longest = windows.agg(F.max("n")).first()[0] or 0
    # each level's windows are written on their own: one plan of all levels shuffles them at once, and the driver's memory grows with that
    level, found, j = rows.select(*KEY, "i", F.col("line").alias("r")), None, 0
    while longest >> j:
        if j:
            level = doubled(level, 1 << (j - 1), scratch)
        own = windows.filter((F.col("n") >= 1 << j) & (F.col("n") < 2 << j))
        head = own.join(level, [*KEY, "i"])
        tail = level.select(*KEY, F.col("i").alias("e"), F.col("r").alias("s"))
        both = head.withColumn("e", F.col("i") + F.col("n") - (1 << j)).join(tail, [*KEY, "e"])
        named = scratch.table(both.select(*KEY, "i", "n", "r", "s"))
        found = named if found is None else found.union(named)
        j += 1
    if found is None:
        return rows.select(*KEY, F.array(F.col("pos")).alias("gone")).limit(0)
    earliest = found.groupBy("n", "r", "s").agg(F.min(F.struct(*KEY, "i")).alias("first"), F.count("*").alias("c")).filter("c > 1")
    earliest = scratch.table(earliest)
    later = found.join(earliest, ["n", "r", "s"]).filter(F.struct(*KEY, "i") > F.col("first"))
    covered = later.select(*KEY, F.explode(F.sequence(F.col("i"), F.col("i") + F.col("n") - 1)).alias("i")).distinct()
    return scratch.table(covered.join(rows.select(*KEY, "i", "pos"), [*KEY, "i"]).groupBy(*KEY).agg(F.array_sort(F.collect_set("pos")).alias("gone")))


def dedup(docs: DataFrame, least: int = 50) -> DataFrame:
    """The rows of docs, with text without later copies of repeated line runs, n_lines and n_removed after their own columns.

    A run of lines with `least` words or more in all that stands earlier (by doc_id, then the
    text's hash, then line) in any document, overlaps included, goes; blank lines neither break a
    run nor go. A null text stays null with no lines, an empty one has one line. A null doc_id
    comes before all others. Rows that repeat doc_id and text are one document and keep the same
    lines. n_chars, if there is one, is the new text's. Columns of docs called n_lines or
    n_removed are replaced.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gone = repeated(narrow, least, scratch)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("string").alias("t"), d.alias("d")).withColumn("h", F.xxhash64("t"))
    wide = wide.join(broadcast_if(gone, 4 * F.size("gone") + 40), KEY, "left")
    # numbers that stay, by a hash set, and then their lines: time grows with the text, however many lines go
    stay = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x["l"]) - 1), x["gone"])
    one = F.array(F.struct(F.split("t", "\n", -1).alias("l"), "gone"))
    kept = F.transform(one, lambda x: F.array_join(F.transform(stay(x), lambda i: x["l"][i]), "\n"))[0]
    wide = wide.withColumn("text", F.when(F.col("gone").isNull(), F.col("t")).otherwise(kept))
    counts = [F.coalesce(F.length("t") - F.length(F.replace("t", F.lit("\n"))) + 1, F.lit(0)).cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_removed")]
    new = {"text": F.col("text")}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.col("gone").isNull(), F.col("row")["n_chars"]).otherwise(F.length("text").cast("long"))
    return wide.select(*[new.get(c, F.col("row")[c]).alias(c) for c in names], *counts)
