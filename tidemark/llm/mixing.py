"""Mixing sources to target weights, with DataFrame functions alone.

The words of a source lie one after another and are packed into blocks of BLOCK; the last may be
short. A source's target is a number of words, hence of slots of a block each, the last of which
takes only the words that are left. Output shards of SHARD slots draw their counts of each source
multinomially: every slot of a shard falls on a source with the probability of its share of all
slots. In the order of shards, a source's i-th slot takes the block that the source's pseudorandom
permutation of its blocks gives for i modulo their number; blocks join by that index. Draws go on
as long as a source's target does; what they leave of it fills closing shards, so targets are met
to the word. No block is taken twice before all of the source are taken once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import Scratch, broadcast_if, partitions, ranked, running

#: Words of a block, slots of an output shard, passes over a source, rounds of the permutation.
BLOCK, SHARD, PASSES, ROUNDS = 64, 4096, 3, 12
#: Ranges into which the line of all slots is cut to find a draw's source, shards whose counts are added up at once.
RANGES, SHARDS = 4096, 1024
WEIGHTS = (5, 2, 1)
#: Rows of a bucket in which places are counted, and most buckets.
BUCKET, MOST_BUCKETS = 256, 1 << 16


def word_count(text: Column) -> Column:
    """Parts between single blanks that are not empty; a cut at one character needs no regular expression."""
    plain = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def targets(sizes: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """(skey, source, place, source_size, target, blocks, keys, slots, cut, words) of each source.

    slots: how many blocks the source gives; the last of them, if words is not null, is block cut
    and gives its first words only. Weights 5, 2, 1 repeat over the sources by code point, null last. Each aggregation fixes the
    sources that the shares so far lift over PASSES times their size and shares the rest anew.
    """
    per = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    per = ranked(scratch, per.withColumn("_n", F.col("source").isNull()), ["_n", "source"], "place").drop("_n")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    per = scratch.table(per.withColumn("weight", weight).withColumn("most", F.col("source_size") * PASSES))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    share, fixed = 0.0, -1
    while True:
        over = F.col("weight") * share > F.col("most") if fixed >= 0 else F.lit(False)
        n, taken, left = per.agg(F.coalesce(F.sum(over.cast("int")), F.lit(0)), F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == fixed or not left:
            break
        share, fixed = (total - taken) / left, n
    target = F.least(F.col("weight") * F.lit(float(share)), F.col("most").cast("double"))
    per = per.withColumn("target", target).withColumn("blocks", F.ceil(F.col("source_size") / BLOCK).cast("long"))
    some_blocks = F.greatest("blocks", F.lit(1))
    per = per.withColumn("keys", F.array(*[F.pmod(F.xxhash64(F.lit(seed), F.lit(r), "skey"), some_blocks) for r in range(ROUNDS)]))
    # whole passes, then left words; the short block lies somewhere in the permuted order
    per = per.withColumn("total", F.least(F.round("target").cast("long"), F.col("most")))
    per = per.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("total div source_size")).otherwise(0)).withColumn("left", F.col("total") - F.col("whole") * F.col("source_size"))
    per = per.withColumn("short_at", permuted(F.greatest(F.col("blocks") - 1, F.lit(0)), some_blocks, F.reverse("keys"), seed + 1)).withColumn("short", F.col("source_size") - (F.col("blocks") - 1) * BLOCK)
    before, on = F.col("left") <= F.col("short_at") * BLOCK, F.col("left") <= F.col("short_at") * BLOCK + F.col("short")
    beyond = F.col("left") - F.col("short")
    per = per.withColumn("full", F.when(before, F.expr(f"left div {BLOCK}")).when(on, F.col("short_at")).otherwise(1 + F.floor(beyond / BLOCK)))
    per = per.withColumn("words", F.when(before, F.col("left") % BLOCK).when(on, F.col("left") - F.col("short_at") * BLOCK).otherwise(beyond % BLOCK))
    per = per.withColumn("slots", F.col("whole") * F.col("blocks") + F.col("full") + (F.col("words") > 0).cast("long"))
    some = F.col("words") > 0
    per = per.withColumn("cut", F.when(some, permuted(F.col("full"), some_blocks, F.col("keys"), seed + 1))).withColumn("words", F.when(some, F.col("words")))
    return scratch.table(per.select("skey", "source", "place", "source_size", "target", "blocks", "keys", "slots", "cut", "words"))


def permuted(x: Column, n: Column, keys: Column, seed: int) -> Column:
    """The image of x under a swap-or-not permutation of 0..n-1; keys: a number in 0..n-1 for each round.

    A round pairs x with key - x (mod n), and a hash of the greater of both says whether they swap,
    so every round is its own inverse whatever n is.
    """

    def round_of(at: Column, key: Column) -> Column:
        other = F.pmod(key - at, n)
        return F.when(F.xxhash64(F.lit(seed), key, F.greatest(at, other)).bitwiseAND(1) == 1, other).otherwise(at)

    return F.aggregate(keys, x, round_of)


def counts(per: DataFrame, seed: int) -> DataFrame:
    """(shard, skey, n): the multinomial draw of each shard's slots over the sources."""
    spark = per.sparkSession
    total = per.agg(F.sum("slots")).first()[0] or 0
    width = max(1, -(-total // RANGES))
    line = running(per.filter("slots > 0").select("skey", "place", "slots"), "place", "slots", "lo").select("skey", "lo", (F.col("lo") + F.col("slots")).alias("hi"))
    line = line.withColumn("range", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))))  # rows: sources and RANGES
    slot = spark.range(0, total, 1, max(1, min(partitions(spark), -(-total // SHARD)))).select(F.expr(f"id div {SHARD}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.lit(max(1, total))).alias("at"))
    side = broadcast_if(line, F.octet_length("skey") + 40)
    drawn = slot.withColumn("range", F.expr(f"at div {width}")).join(side, "range").filter("at >= lo and at < hi")
    return drawn.groupBy("shard", "skey").agg(F.count("*").alias("n"))


def draws(per: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """(skey, slot, block, shard): a row for each slot of each source."""
    per = per.filter("slots > 0")
    drawn = scratch.table(counts(per, seed).withColumn("group", F.expr(f"shard div {SHARDS}")))
    groups = drawn.groupBy("skey", "group").agg(F.sum("n").alias("all"))
    before = lambda by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("skey", "group", F.coalesce(F.sum("all").over(before(["skey", "group"])), F.lit(0)).alias("from"))
    within = F.coalesce(F.sum("n").over(before(["skey", "group", "shard"])), F.lit(0))
    runs = drawn.withColumn("within", within).join(starts, ["skey", "group"]).select("skey", "shard", (F.col("from") + F.col("within")).alias("lo"), "n")
    # what the draws leave of a source goes to closing shards, in runs of SHARD slots at most
    given = drawn.groupBy("skey").agg(F.sum("n").alias("given"))
    rest = per.join(given, "skey", "left").withColumn("given", F.coalesce("given", F.lit(0))).filter("given < slots")
    first = (drawn.agg(F.max("shard")).first()[0] or 0) + 1
    closing = max(1, -(-(rest.agg(F.sum(F.col("slots") - F.col("given"))).first()[0] or 0) // SHARD))
    rest = rest.select("skey", F.explode(F.sequence("given", F.col("slots") - 1, F.lit(SHARD).cast("long"))).alias("lo"))
    rest = rest.select("skey", (F.lit(first) + F.pmod(F.xxhash64(F.lit(seed + 3), "skey", "lo"), F.lit(closing))).alias("shard"), "lo", F.lit(SHARD).cast("long").alias("n"))
    runs = runs.unionByName(rest).join(broadcast_if(per.select("skey", "blocks", "keys", "slots"), F.octet_length("skey") + 8 * ROUNDS + 40), "skey")
    # written, since one plan of draws and pieces runs so many shuffles at once that the driver's memory grows
    runs = scratch.table(runs.withColumn("hi", F.least(F.col("lo") + F.col("n"), "slots")).filter("lo < hi").select("skey", "shard", "blocks", "keys", "lo", "hi"))
    slots = runs.select("skey", "shard", "blocks", "keys", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("slot"))
    return slots.select("skey", "slot", permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("keys"), seed + 1).alias("block"), "shard")


def placed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, h, source, skey, size, start) of each row: where its words lie among its source's."""
    skey = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    rows = scratch.table(docs.select("doc_id", "source", skey.alias("skey"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("h")))
    buckets = max(1, min(MOST_BUCKETS, rows.count() // BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h"), F.lit(buckets)))
    order = Window.partitionBy("skey", "bucket").orderBy("doc_id", "h")
    rows = rows.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("all")).select("skey", "bucket", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("from"))
    return scratch.table(rows.join(starts, ["skey", "bucket"]).select("doc_id", "h", "source", "skey", "size", (F.col("from") + F.col("within")).alias("start")))


def pieces_of(rows: DataFrame, per: DataFrame) -> DataFrame:
    """The columns of rows, block, lo, hi, head: the pieces of each document, cut at blocks and where a source's last slot
    ends (head: before that end). A document without words has one piece with nulls.
    """
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / BLOCK), last))
    cut = rows.withColumn("block", F.explode_outer(blocks))
    side = per.filter("words is not null").select("skey", "cut", (F.col("cut") * BLOCK + F.col("words")).alias("end"))
    cut = cut.join(broadcast_if(side, F.octet_length("skey") + 24), "skey", "left")
    lo = F.greatest(F.col("block") * BLOCK, F.col("start"))
    hi = F.least(F.col("block") * BLOCK + BLOCK, F.col("start") + F.col("size"))
    own = F.coalesce(F.col("block") == F.col("cut"), F.lit(False))
    piece = lambda a, b, head: F.struct((a - F.col("start")).alias("lo"), (b - F.col("start")).alias("hi"), head.alias("head"))
    split = F.when(own & (lo < F.col("end")) & (F.col("end") < hi), F.array(piece(lo, F.col("end"), F.lit(True)), piece(F.col("end"), hi, F.lit(False))))
    cut = cut.withColumn("piece", F.explode(split.otherwise(F.array(piece(lo, hi, own & (hi <= F.col("end")))))))
    return cut.select(*rows.columns, "block", "piece.lo", "piece.hi", F.when(own, F.col("piece.head")).otherwise(True).alias("head"))


def parts(rows: DataFrame, per: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """(the columns of rows, lo, hi, times, shards): the pieces, how often the mix takes each, and for which shards."""
    ends = per.select("skey", (F.col("slots") - 1).alias("ends"), F.col("words").isNotNull().alias("partly"))
    drawn = draws(per, scratch, seed).join(broadcast_if(ends, F.octet_length("skey") + 16), "skey")
    rest = F.col("partly") & (F.col("slot") == F.col("ends"))
    # at most PASSES slots take a block, so these lists are short
    times = drawn.groupBy("skey", "block").agg(F.array_sort(F.collect_list(F.struct(rest.alias("rest"), "shard"))).alias("slots"))
    # the planner takes the draws, made from a few rows, for small; they grow with the corpus
    got = pieces_of(rows, per).join(times.hint("merge"), ["skey", "block"], "left")
    taken = F.filter("slots", lambda x: F.col("head") | ~x["rest"])
    shards = F.coalesce(F.transform(taken, lambda x: x["shard"]), F.array().cast("array<long>"))
    return got.select(*rows.columns, "lo", "hi", shards.alias("shards")).withColumn("times", F.size("shards").cast("long"))


def mix_of(docs: DataFrame, scratch: Scratch, seed: int) -> tuple[DataFrame, DataFrame]:
    """Each row's place among its source's words, and the sources."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    rows = placed(docs, scratch)
    return rows, targets(rows, scratch, seed)


def plan(docs: DataFrame, seed: int = 20240607) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken, shards.

    size: words of the text, 0 if it is null or blank; source_size and target: its source's; a
    null source is a source, the last. taken: words that the mix takes of it, repeats counted, at
    most PASSES times size; each source's taken words are its target, rounded. shards: those that
    hold words of it, in order. Rows that repeat are rows of their own. The same input gives the
    same result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, per = mix_of(docs, scratch, seed)
    taken = F.coalesce(F.sum((F.col("hi") - F.col("lo")) * F.col("times")), F.lit(0)).cast("long")
    shards = F.array_sort(F.array_distinct(F.flatten(F.collect_list("shards"))))
    out = parts(rows.filter("size > 0"), per, scratch, seed).groupBy("skey", "start", "doc_id", "h", "source", "size").agg(taken.alias("taken"), shards.alias("shards"))
    out = out.select("skey", "doc_id", "source", "size", "taken", "shards")
    out = out.unionByName(rows.filter("size = 0").select("skey", "doc_id", "source", "size", F.lit(0).cast("long").alias("taken"), F.array().cast("array<long>").alias("shards")))
    side = broadcast_if(per.select("skey", "source_size", "target"), F.octet_length("skey") + 24)
    return out.join(side, "skey").select("doc_id", "source", "size", "source_size", "target", "taken", "shards")


def mixed_blocks(docs: DataFrame, seed: int = 20240607) -> DataFrame:
    """The mix itself, a row a slot: shard, source, slot, block, n_words, text (its words, single blanks between).

    All blocks hold BLOCK words but the last of a source and the last slot that it gives.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, per = mix_of(docs, scratch, seed)
    skey = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    wide = docs.select(F.col("doc_id").cast("long").alias("d"), F.col("text").cast("string").alias("t"), skey.alias("s")).withColumn("x", F.xxhash64("t"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "h", "skey").orderBy("start"))
    wide = wide.withColumn("c", F.row_number().over(Window.partitionBy("d", "x", "s").orderBy("t")))
    at = pieces_of(rows.filter("size > 0").withColumn("copy", copy), per.withColumn("words", F.lit(None).cast("long")))
    on = wide["d"].eqNullSafe(at["doc_id"]) & (wide["x"] == at["h"]) & (wide["s"] == at["skey"]) & (wide["c"] == at["copy"])
    words = F.slice(F.regexp_extract_all("t", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
    cut = at.join(wide, on).select("skey", "block", "start", "lo", words.alias("w"))
    blocks = cut.groupBy("skey", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "lo", "w"))), lambda p: p["w"])).alias("w"))
    slots = draws(per, scratch, seed).join(broadcast_if(per.select("skey", "source", "slots", "words"), F.octet_length("skey") + 24), "skey")
    got = slots.join(blocks, ["skey", "block"]).withColumn("w", F.when((F.col("slot") == F.col("slots") - 1) & F.col("words").isNotNull(), F.slice("w", 1, F.col("words").cast("int"))).otherwise(F.col("w")))
    return got.select("shard", "source", "slot", "block", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("text"))


def mixed_documents(docs: DataFrame, seed: int = 20240607) -> DataFrame:
    """Pipeline stage: the documents as the mix takes them, with the columns of docs.

    A document comes back once for each pass that takes any of its words, with the words taken
    (and the white space before each) as text; a pass that takes all gives the text as it is.
    Documents without words are not taken.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, per = mix_of(docs, scratch, seed)
    cut = parts(rows.filter("size > 0"), per, scratch, seed).filter("times > 0")
    piece = F.struct("lo", "hi", "times")
    lists = cut.groupBy("skey", "start", "doc_id", "h", "size").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    lists = lists.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.array_max(F.col("pieces")["times"]))))
    lists = lists.withColumn("pieces", F.filter("pieces", lambda p: p["times"] >= F.col("k")))
    covered = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["hi"] - p["lo"])
    lists = lists.withColumn("whole", covered == F.col("size")).withColumn("pieces", F.when(~F.col("whole"), F.col("pieces")))
    again = Window.partitionBy("doc_id", "h", "skey", "k").orderBy("start")
    lists = scratch.table(lists.withColumn("copy", F.row_number().over(again)).select("doc_id", "h", "skey", "copy", "whole", "pieces"))
    skey = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    names = docs.columns
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("d"), F.col("text").cast("string").alias("t"), skey.alias("s")).withColumn("x", F.xxhash64("t"))
    if lists.filter("copy > 1").isEmpty():
        wide = wide.withColumn("n", F.lit(1))
    else:  # rows that repeat get one plan each
        wide = wide.withColumn("n", F.row_number().over(Window.partitionBy("d", "x", "s").orderBy("t")))
    on = wide["d"].eqNullSafe(lists["doc_id"]) & (wide["x"] == lists["h"]) & (wide["s"] == lists["skey"]) & (wide["n"] == lists["copy"])
    got = wide.join(lists, on)
    tokens = F.regexp_extract_all("t", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    some = F.array_join(F.flatten(F.transform("pieces", lambda p: F.slice(tokens, (p["lo"] + 1).cast("int"), (p["hi"] - p["lo"]).cast("int")))), "")
    got = got.withColumn("t", F.when(F.col("whole"), F.col("t")).otherwise(some))
    new = {"text": F.col("t"), "n_chars": F.length("t").cast("long")}
    return got.select(*[new.get(c, F.col("row")[c]).alias(c) for c in names])
