"""Plumbing shared by the training-data operators: scratch tables, words, components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts: blank and the controls tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"


@functools.cache
def _own_folder() -> str:
    """A folder for sessions that name none; only where driver and executors are one process."""
    folder = tempfile.TemporaryDirectory(prefix="tidemark-")
    atexit.register(folder.cleanup)
    return f"file://{folder.name}"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir."""
    if own := spark.conf.get("spark.checkpoint.dir", None):
        return own.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return _own_folder()


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


class Scratch:
    """Tables written in the shared folder, so that lost executors cost no lineage.

    What no later step reads is dropped as soon as that is known; what a result reads, when the
    driver's process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}", 0
        self.live: dict[str, None] = {}
        _roots.append((spark, self.root))

    def path(self) -> str:
        self.n += 1
        return f"{self.root}/{self.n}"

    def table(self, df: DataFrame) -> DataFrame:
        df.write.parquet(path := self.path())
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        self.live[path] = None
        return out

    def drop(self, *tables: DataFrame) -> None:
        """For tables that no later result reads."""
        for t in tables:
            self.live.pop(t.scratch_path, None)
            remove(self.spark, t.scratch_path)

    def keep(self, *tables: DataFrame) -> None:
        """Drops all tables but these."""
        kept = {t.scratch_path for t in tables}
        for path in [p for p in self.live if p not in kept]:
            del self.live[path]
            remove(self.spark, path)


_roots: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_roots() -> None:
    from py4j.protocol import Py4JError, Py4JNetworkError

    for spark, root in _roots:
        try:
            remove(spark, root)
        except (Py4JError, Py4JNetworkError, OSError):  # the JVM has gone already
            return


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Fewer rows in an Arrow batch: workers and executors hold whole texts of a batch, which may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def trim() -> None:
    """Gives memory that this process has freed back to the system, if its C library can: workers outlive their tasks."""
    with contextlib.suppress(OSError, AttributeError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of a broadcast side at most.
MOST_BROADCAST = 16 << 20


def broadcast_if(df: DataFrame, size: Column, most: int = MOST_BROADCAST) -> DataFrame:
    """A broadcast side only if its rows' sizes, given in bytes and added up, are below a bound; else Spark's shuffled join."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= most else df


#: Parts into which a key's rows are dealt where their partner is too large to be broadcast.
SALT = 64


def spread_join(left: DataFrame, right: DataFrame, key: str, size: Column, salt: Column) -> DataFrame:
    """left with its row of right, one at most for each key, if there is one. No key's rows of left meet in one task."""
    if right.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= MOST_BROADCAST:
        return left.join(F.broadcast(right), key, "left")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SALT)).cast("int")).join(copies, [key, "_salt"], "left").drop("_salt")


def words(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z lower-cased; bytes.split() cuts at exactly the BLANK characters."""
    return text.encode().lower().split() if text else []


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def ranked(scratch: Scratch, df: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows with their place (from 0) in the order of the columns by, nulls first; no task sees all rows."""
    from pyspark.sql import Window

    dealt = scratch.table(df.repartitionByRange(*by).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = dealt.groupBy("_p").count().withColumn("_s", F.coalesce(F.sum("count").over(before), F.lit(0))).select("_p", "_s")
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*by))
    return dealt.join(F.broadcast(starts), "_p").withColumn(name, F.col("_s") + within - 1).drop("_p", "_s")


def running(df: DataFrame, place: str, value: str, name: str, most: int = 4096) -> DataFrame:
    """The rows with the sum of value over all rows of smaller place (0, 1, 2, ...); no task sees more than most rows but one sum each."""
    from pyspark.sql import Window

    df = df.withColumn("_part", F.floor(F.col(place) / most))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy("_part").agg(F.sum(value).alias("_all")).select("_part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_from"))
    within = F.sum(value).over(Window.partitionBy("_part").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    return df.withColumn("_within", within).join(starts, "_part").withColumn(name, F.col("_from") + F.col("_within")).drop("_part", "_from", "_within")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b); root names the component.

    Each round every node follows its neighbour of least random rank, edges are renamed and
    repeats dropped, so a constant share of them goes; all rounds are joins and aggregations.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    edges = scratch.table(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        step = scratch.table(near.select(F.col("a").alias("node"), F.least(F.col("m"), rank("a"))["n"].alias("to")))
        steps.append(step)
        left, right = step.toDF("a", "x"), step.toDF("b", "y")
        renamed = edges.join(left, "a").join(right, "b").filter("x <> y")
        following = scratch.table(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        scratch.drop(edges)
        edges = following
    if not steps:
        return scratch.table(edges.select(F.col("a").alias("node"), F.col("a").alias("root")))
    out = steps[0].toDF("node", "root")
    for i, step in enumerate(steps[1:]):
        out = out.join(step.toDF("root", f"to{i}"), "root", "left").select("node", F.coalesce(f"to{i}", "root").alias("root"))
    out = scratch.table(out)
    scratch.drop(edges, *steps)
    return out
