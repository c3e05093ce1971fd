"""Queries over a managed copy of orders, and SQL that gives the same rows."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.transforms import Transform
from tidemark.operators.table import ManagedTable
from tidemark.streaming.sink import append_stream

from .session import ManagedSession

_tables: dict[tuple, ManagedTable] = {}


@functools.cache
def _own_folder() -> str:
    """A folder for sessions that name none; only where driver and executors are one process."""
    folder = tempfile.TemporaryDirectory(prefix="tidemark-")
    atexit.register(folder.cleanup)
    return f"file://{folder.name}"


def shared(spark: SparkSession) -> str:
    if own := spark.conf.get("spark.checkpoint.dir", None):
        return own.rstrip("/")
    if not spark.sparkContext.master.partition("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return _own_folder()


def plain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(spark, sf_dir, "orders").withColumns({"o_ym": F.date_format("o_orderdate", "yyyyMM"), "o_year": F.date_format("o_orderdate", "yyyy")})


def one_file(df: DataFrame) -> DataFrame:
    """Rows of a partition in one task, so that it gets one file."""
    return df.repartition("o_year")


def scenario(spark: SparkSession, sf_dir: str, steps: str) -> ManagedTable:
    """A table made by named steps, kept for the session: each state is made once."""
    key = (spark.sparkContext.applicationId, sf_dir, steps)
    if key in _tables:
        return _tables[key]
    rows = source(spark, sf_dir)
    t = ManagedTable.create(spark, f"{shared(spark)}/tidemark/orders-{uuid.uuid4().hex}", rows.schema, ["o_year"], "o_ym=o_year:truncate[4]", name="orders_m")
    for step in steps.split():
        if step == "append":
            t.append(one_file(rows))
        elif step == "all":
            t.overwrite(one_file(rows))
        elif step == "1996":
            t.overwrite(one_file(rows.where("o_year = '1996'")), {"o_year": "1996"})
        elif step == "1997":
            t.overwrite(one_file(rows.where("o_year = '1997' and o_totalprice < 100000")), {"o_year": "1997"})
        elif step == "drop1996":
            t.overwrite(rows.where("1 = 0"), {"o_year": "1996"})
        elif step == "keep1996":
            t.overwrite(one_file(rows), {"o_year": "1996"}, if_not_exists=True)
        elif step == "copy1995":
            t.append(one_file(rows.where("o_year = '1995'")).drop("o_year"), {"o_year": "1996"})
        elif step == "dynamic":
            t.overwrite(one_file(rows.where("o_year = '1996' and o_totalprice < 100000")), dynamic=True)
        elif step == "nothing":
            t.append(rows.where("1 = 0"))
        elif step == "itself":
            t.overwrite(one_file(t.scan("o_totalprice < 200000")))
    _tables[key] = t
    return t


SC1, SC2, SC3 = "append", "append append", "append append all"
SC4, SC5, SC6 = f"{SC3} 1996", f"{SC3} 1996 1997", "append drop1996"
M = "(select *, strftime(o_orderdate,'%Y%m') as o_ym, strftime(o_orderdate,'%Y') as o_year from orders)"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenario(spark, sf_dir, SC1).scan().groupBy("o_year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("s"))


def _session(spark: SparkSession, sf_dir: str, steps: str) -> ManagedSession:
    s = ManagedSession(spark, f"{shared(spark)}/tidemark/warehouse")
    s.tables["orders_m"] = scenario(spark, sf_dir, steps)
    plain(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    return s


def _sql(steps: str, text: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _session(spark, sf_dir, steps).sql(text)


def _as_of(steps: str, number: int, text: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = _session(spark, sf_dir, steps)
        at = s.tables["orders_m"].metadata["snapshots"][number - 1]["time"] if number else 0
        return s.sql(f"AS OF '{at}' {text}")

    return run


def _scan(steps: str, where: str, columns: list[str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: scenario(spark, sf_dir, steps).scan(where, columns)


def snapshots_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _session(spark, sf_dir, SC5).sql("select * from `orders_m$snapshots`")
    order = Window.orderBy("timeMillis")  # a row for each snapshot
    return view.select(F.row_number().over(order).alias("seq"), (F.col("parentId") == -1).alias("is_root"), F.col("numAddedFiles").cast("long").alias("added"), F.col("numdDeletedFiles").cast("long").alias("deleted"))


def empty_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenario(spark, sf_dir, "append nothing").snapshots().agg(F.count("*").alias("n"))


def files_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scenario(spark, sf_dir, SC1).files()
    of = lambda c, k: F.get_json_object(F.col("columns")[c], f"$.{k}").cast("long")
    rows = files.select(F.get_json_object("partition", "$.o_year").alias("o_year"), "record_count", of("o_orderkey", "lower").alias("lo"), of("o_orderkey", "upper").alias("hi"), of("o_custkey", "nulls").alias("nulls"))
    return rows.groupBy("o_year").agg(F.sum("record_count").alias("record_count"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("nulls").alias("nulls"))


def files_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that scans read, of how many: by partition, dependency, statistics, and none at all."""
    t = scenario(spark, sf_dir, SC1)
    plans = [(k, t.plan(w)) for k, w in (("partition", "o_year = '1996'"), ("dependency", "o_ym = '199603'"), ("range", "o_ym >= '199603' and o_ym < '199702'"), ("none", "o_orderkey < 0"))]
    return spark.createDataFrame([(k, len(p.files)) for k, p in plans], "kind string, files long")


def transform_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, number = Transform("truncate[2]", T.StringType()), Transform("truncate[10]", T.LongType())
    return scenario(spark, sf_dir, SC1).scan().select("o_orderkey", text.column(F.col("o_orderpriority")).alias("ts"), number.column(F.col("o_orderkey")).alias("tl"))


def transform_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda k: Transform(k, T.TimestampNTZType()).column(F.col("o_orderdate")).cast("int").alias(k[0])
    return scenario(spark, sf_dir, SC1).scan().select("o_orderkey", of("year"), of("month"), of("day"))


def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = Transform("bucket[8]", T.LongType())
    return scenario(spark, sf_dir, SC1).scan().select(bucket.column(F.col("o_orderkey")).alias("b")).groupBy("b").agg(F.count("*").alias("n"))


def ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _session(spark, sf_dir, SC1)
    name = f"t_{uuid.uuid4().hex[:12]}"
    s.sql(f"create table {name} using parquet options (addTableManagement 'true', columnDependencies 'o_ym=o_year:truncate[4]') partitioned by (o_year) as select o_orderkey, o_totalprice, o_ym, o_year from orders_m where o_year < '1998'")
    s.sql(f"insert overwrite table {name} partition (o_year = '1996') select o_orderkey, o_totalprice, o_ym from orders_m where o_year = '1996' and o_totalprice < 100000")
    return s.sql(f"select o_year, count(*) as n from {name} group by o_year")


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenario(spark, sf_dir, SC5).partitions()


def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenario(spark, sf_dir, SC1).scan(columns=["o_orderkey"]).exceptAll(scenario(spark, sf_dir, SC5).scan(columns=["o_orderkey"]))


def fresh(s: ManagedSession, columns: str, options: str = "") -> str:
    """A new managed table by o_year; its name."""
    name = f"t_{uuid.uuid4().hex[:12]}"
    s.sql(f"create table {name} ({columns}) using parquet options (addTableManagement 'true', columnDependencies 'o_ym=o_year:truncate[4]'{options}) partitioned by (o_year)")
    return name


NARROW = "o_orderkey bigint, o_totalprice double, o_ym string, o_year string"


def _filled(statements: str, then: str, options: str = "", conf: dict[str, str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    """Statements over a new table {t} beside orders_m, and a query of it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = _session(spark, sf_dir, SC1)
        t = fresh(s, NARROW, options)
        before = {k: spark.conf.get(k) for k in conf or {}}
        for k, v in (conf or {}).items():
            spark.conf.set(k, v)
        try:
            for statement in statements.split(";"):
                s.sql(statement.strip().format(t=t))
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        return s.sql(then.format(t=t))

    return run


def _counted(text: str, *filters: str) -> Callable[[SparkSession, str], DataFrame]:
    """Rows of a statement under later filters, and files that it reads of orders_m, of how many."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = _session(spark, sf_dir, SC1)
        df = s.sql(text)
        for f in filters:
            df = df.where(f)
        files, total, _ = s.last_plan["orders_m"]
        return df.agg(F.count("*").alias("n")).select("n", F.lit(files).cast("long").alias("files"), F.lit(total).cast("long").alias("total"))

    return run


def names_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that another session made is found, and is gone after DROP TABLE."""
    s = _session(spark, sf_dir, SC1)
    t = fresh(s, NARROW)
    s.sql(f"insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m where o_year = '1996'")
    other = _session(spark, sf_dir, SC1)
    seen = other.sql(f"select count(*) from {t}").first()[0]
    other.sql(f"drop table {t}")
    s.sync()
    return spark.createDataFrame([(seen, t in s.tables)], "seen long, left boolean")


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stream, a snapshot for each micro-batch."""
    rows = source(spark, sf_dir)
    name = uuid.uuid4().hex
    t = ManagedTable.create(spark, f"{shared(spark)}/tidemark/stream-{name}", rows.schema, ["o_year"], "o_ym=o_year:truncate[4]")
    stream = spark.readStream.schema(plain(spark, sf_dir, "orders").schema).parquet(f"{sf_dir}/orders*.parquet")
    stream = stream.withColumns({"o_ym": F.date_format("o_orderdate", "yyyyMM"), "o_year": F.date_format("o_orderdate", "yyyy")})
    append_stream(stream, t, f"{shared(spark)}/tidemark/checkpoint-{name}").trigger(availableNow=True).start().awaitTermination()
    t.refresh()
    return t.scan().groupBy("o_year").agg(F.count("*").alias("n"))


def two_tables_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AS OF holds for every table of its statement."""
    s = _session(spark, sf_dir, SC2)
    first = s.tables["orders_m"].metadata["snapshots"][0]["time"]
    t = fresh(s, NARROW)
    for _ in range(2):
        s.sql(f"insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m where o_year = '1996'")
    second = s.tables[t].metadata["snapshots"][0]["time"]
    both = s.sql(f"AS OF '{second}' select (select count(*) from orders_m) as n, (select count(*) from {t}) as m")
    return both.withColumn("before", F.lit(first < second))


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scenario(spark, sf_dir, SC5).statistics()
    return spark.createDataFrame([(got["files"], got["rows"], got["bytes"] > 0)], "files long, n long, sized boolean")


def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each save mode in turn on one table."""
    rows = one_file(source(spark, sf_dir).where("o_year = '1996'"))
    t = ManagedTable.create(spark, f"{shared(spark)}/tidemark/modes-{uuid.uuid4().hex}", rows.schema, ["o_year"])
    out = []
    for i, mode in enumerate(("error", "append", "ignore", "overwrite", "error")):
        try:
            t.insert(rows, mode)
            failed = False
        except FileExistsError:
            failed = True
        out.append((i, mode, t.statistics()["rows"], failed))
    return spark.createDataFrame(out, "i int, mode string, n long, failed boolean")


def transform_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda k, kind, c: Transform(k, kind).column(c)
    day, cents = F.col("o_orderdate").cast("date"), F.round("o_totalprice", 2).cast("decimal(18,2)")
    return scenario(spark, sf_dir, SC1).scan().select(
        "o_orderkey", of("identity", T.StringType(), F.col("o_orderstatus")).alias("i"), of("hour", T.TimestampNTZType(), F.col("o_orderdate")).cast("long").alias("h"),
        of("year", T.DateType(), day).cast("int").alias("y"), of("month", T.DateType(), day).cast("int").alias("m"), of("day", T.DateType(), day).cast("int").alias("d"),
        of("truncate[500]", T.DecimalType(18, 2), cents).cast("double").alias("td"),
    )


def by_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("double")
    def taxed(price: pd.Series) -> pd.Series:
        return price * 2

    return scenario(spark, sf_dir, SC1).scan("o_year = '1996'").select("o_orderkey", taxed("o_totalprice").alias("x"))


def formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Managed tables of other formats: rows of each, pruned by partition."""
    out = []
    for kind in ("orc", "json", "csv"):
        rows = one_file(source(spark, sf_dir).select("o_orderkey", "o_year"))
        t = ManagedTable.create(spark, f"{shared(spark)}/tidemark/format-{uuid.uuid4().hex}", rows.schema, ["o_year"], file_format=kind)
        t.append(rows)
        out.append((kind, t.scan("o_year = '1996'").count(), len(t.plan("o_year = '1996'").files)))
    return spark.createDataFrame(out, "kind string, n long, files long")


#: murmur3 of eight little-endian bytes in whole-number arithmetic.
_M = 4294967296


def _bucket_sql(width: int) -> str:
    turn = lambda x, n: f"((({x}) * {1 << n}) % {_M} + ({x}) // {1 << (32 - n)})"
    mixed = lambda k: f"(({turn(f'((({k}) * 3432918353) % {_M})', 15)} * 461845907) % {_M})"
    # a step a subquery, so that no expression stands twice
    steps = [
        ("k1", f"select cast(o_orderkey % {_M} as hugeint) as lo, cast(o_orderkey // {_M} as hugeint) as hi from orders"),
        ("k2", f"select {mixed('lo')} as a, {mixed('hi')} as b from k1"),
        ("k3", f"select ({turn('a', 13)} * 5 + 3864292196) % {_M} as h, b from k2"),
        ("k4", "select cast(xor(cast(h as bigint), cast(b as bigint)) as hugeint) as h from k3"),
        ("k5", f"select ({turn('h', 13)} * 5 + 3864292196) % {_M} as h from k4"),
        ("k6", "select cast(xor(cast(h as bigint), 8) as bigint) as h from k5"),
        ("k7", f"select (cast(xor(h, h // 65536) as hugeint) * 2246822507) % {_M} as h from k6"),
        ("k8", f"select (cast(xor(cast(h as bigint), cast(h // 8192 as bigint)) as hugeint) * 3266489909) % {_M} as h from k7"),
        ("k9", "select xor(cast(h as bigint), cast(h // 65536 as bigint)) as h from k8"),
    ]
    return "with " + ", ".join(f"{n} as ({q})" for n, q in steps) + f" select cast((h % 2147483648) % {width} as integer) as b, count(*) as n from k9 group by 1"


_COUNT = "select count(*) as n from orders_m"
_BY_YEAR = "select o_year, count(*) as n from orders_m group by o_year"
_KEYS = ["o_orderkey"]

_ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "q_append_scan": (_sql(SC1, "select * from orders_m"), f"select * from {M}"),
    "q_append_count": (_sql(SC1, _COUNT), "select count(*) as n from orders"),
    "q_append_twice_count": (_sql(SC2, _COUNT), "select 2*count(*) as n from orders"),
    "q_as_of_first": (_as_of(SC2, 1, _COUNT), "select count(*) as n from orders"),
    "q_as_of_before_first": (_as_of(SC2, 0, _COUNT), "select 2*count(*) as n from orders"),
    "q_as_of_second_after_overwrite": (_as_of(SC5, 2, _COUNT), "select 2*count(*) as n from orders"),
    "q_overwrite_all": (_sql(SC3, "select o_year, count(*) as n, round(sum(o_totalprice),2) as s from orders_m group by o_year"), f"select o_year, count(*) as n, round(sum(o_totalprice),2) as s from {M} group by o_year"),
    "q_overwrite_partition": (_sql(SC5, "select * from orders_m"), f"select * from {M} where o_year<>'1997' or o_totalprice<100000"),
    "q_overwrite_partition_agg": (_sql(SC5, _BY_YEAR), f"select o_year, count(*) as n from {M} where o_year<>'1997' or o_totalprice<100000 group by o_year"),
    "q_overwrite_if_not_exists": (_sql("append keep1996", _COUNT), "select count(*) as n from orders"),
    "q_insert_static_partition": (_sql("append copy1995", _BY_YEAR), f"select o_year, count(*) as n from (select o_year from {M} union all select '1996' from {M} where o_year='1995') t group by o_year"),
    "q_dynamic_overwrite": (_sql("append dynamic", "select * from orders_m"), f"select * from {M} where o_year<>'1996' or o_totalprice<100000"),
    "q_delete_partition": (_sql(SC6, "select * from orders_m"), f"select * from {M} where o_year<>'1996'"),
    "q_empty_insert_no_snapshot": (empty_insert, "select cast(1 as bigint) as n"),
    "q_null_scan": (_sql(SC5, f"{_COUNT} where o_year='1997' and o_totalprice>100000"), f"select count(*) as n from {M} where o_year='1997' and o_totalprice<100000 and o_totalprice>100000"),
    "q_snapshots_view": (snapshots_view, f"with y as (select count(distinct o_year) as c from {M}) select cast(seq as integer) as seq, is_root, cast(added as bigint) as added, cast(deleted as bigint) as deleted from (select 1 as seq, true as is_root, c as added, 0 as deleted from y union all select 2, false, c, 0 from y union all select 3, false, c, 2*c from y union all select 4, false, 1, 1 union all select 5, false, 1, 1) t"),
    "q_partitions": (partitions, f"select distinct o_year from {M} where o_year<>'1997' or o_totalprice<100000"),
    "q_files_metrics": (files_metrics, f"select o_year, count(*) as record_count, min(o_orderkey) as lo, max(o_orderkey) as hi, count(*)-count(o_custkey) as nulls from {M} group by o_year"),
    "q_files_pruned": (files_pruned, f"select 'partition' as kind, cast(count(distinct o_year) as bigint) as files from {M} where o_year='1996' union all select 'dependency', cast(count(distinct o_year) as bigint) from {M} where o_year='1996' union all select 'range', cast(count(distinct o_year) as bigint) from {M} where o_year in ('1996','1997') union all select 'none', cast(0 as bigint)"),
    "q_ctas_overwrite": (ctas, f"select o_year, count(*) as n from {M} where o_year<'1998' and (o_year<>'1996' or o_totalprice<100000) group by o_year"),
    "q_pred_eq": (_scan(SC1, "o_orderkey=77", _KEYS), "select o_orderkey from orders where o_orderkey=77"),
    "q_pred_flipped": (_scan(SC1, "100>o_orderkey", _KEYS), "select o_orderkey from orders where 100>o_orderkey"),
    "q_pred_range": (_scan(SC1, "o_totalprice>=1000 and o_totalprice<50000", _KEYS), "select o_orderkey from orders where o_totalprice>=1000 and o_totalprice<50000"),
    "q_pred_in": (_scan(SC1, "o_year in ('1995','2001')", _KEYS), f"select o_orderkey from {M} where o_year in ('1995','2001')"),
    "q_pred_inset": (_scan(SC1, "o_orderkey in (1,2,3,4,5,6,7,8,9,10,11,12,13,14,15)", _KEYS), "select o_orderkey from orders where o_orderkey in (1,2,3,4,5,6,7,8,9,10,11,12,13,14,15)"),
    "q_pred_or": (_scan(SC1, "o_year='1996' or o_orderkey<50", _KEYS), f"select o_orderkey from {M} where o_year='1996' or o_orderkey<50"),
    "q_pred_not": (_scan(SC1, "not (o_year='1996' or o_totalprice>50000)", _KEYS), f"select o_orderkey from {M} where not (o_year='1996' or o_totalprice>50000)"),
    "q_pred_isnull": (_sql(SC1, f"{_COUNT} where o_custkey is null"), "select count(*) as n from orders where o_custkey is null"),
    "q_pred_notnull": (_sql(SC1, f"{_COUNT} where o_custkey is not null"), "select count(*) as n from orders where o_custkey is not null"),
    "q_pred_nullsafe": (_sql(SC1, f"{_COUNT} where o_year <=> '1996'"), f"select count(*) as n from {M} where o_year is not distinct from '1996'"),
    "q_pred_like": (_scan(SC1, "o_ym like '1996%'", _KEYS), f"select o_orderkey from {M} where o_ym like '1996%'"),
    "q_pred_ts": (_scan(SC1, "o_orderdate < timestamp_ntz '1996-01-01'", _KEYS), "select o_orderkey from orders where o_orderdate<timestamp '1996-01-01'"),
    "q_pred_unpushable": (_scan(SC1, "o_orderkey%7=3", _KEYS), "select o_orderkey from orders where o_orderkey%7=3"),
    "q_dep_eq": (_scan(SC1, "o_ym='199603'", _KEYS), f"select o_orderkey from {M} where o_ym='199603'"),
    "q_dep_range": (_scan(SC1, "o_ym>='199603' and o_ym<'199702'", _KEYS), f"select o_orderkey from {M} where o_ym>='199603' and o_ym<'199702'"),
    "q_dep_in": (_scan(SC1, "o_ym in ('199503','200101')", _KEYS), f"select o_orderkey from {M} where o_ym in ('199503','200101')"),
    "q_dep_not": (_sql(SC1, f"{_COUNT} where not (o_ym='199603')"), f"select count(*) as n from {M} where not (o_ym='199603')"),
    "q_transform_truncate": (transform_truncate, "select o_orderkey, substr(o_orderpriority,1,2) as ts, o_orderkey-(((o_orderkey%10)+10)%10) as tl from orders"),
    "q_transform_time": (transform_time, "select o_orderkey, cast(year(o_orderdate)-1970 as integer) as y, cast((year(o_orderdate)-1970)*12+month(o_orderdate)-1 as integer) as m, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as d from orders"),
    "q_transform_bucket": (bucket_counts, _bucket_sql(8)),
    "q_transform_more": (transform_more, "select o_orderkey, o_orderstatus as i, cast(floor(epoch(o_orderdate)/3600) as bigint) as h, cast(year(o_orderdate)-1970 as integer) as y, cast((year(o_orderdate)-1970)*12+month(o_orderdate)-1 as integer) as m, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as d, cast(floor(round(o_totalprice,2)/5)*5 as double) as td from orders"),
    "q_insert_columns": (_filled("insert into {t} (o_totalprice, o_year, o_orderkey) select o_totalprice, o_year, o_orderkey from orders_m where o_year = '1996'", "select * from {t}"), f"select o_orderkey, o_totalprice, cast(null as varchar) as o_ym, o_year from {M} where o_year='1996'"),
    "q_insert_by_name": (_filled("insert into {t} by name select o_year, o_ym, o_totalprice, o_orderkey from orders_m where o_year = '1996'; insert into {t} by name select '1999' as o_year, o_orderkey from orders_m where o_year = '1997'", "select * from {t}"), f"select o_orderkey, o_totalprice, o_ym, o_year from {M} where o_year='1996' union all select o_orderkey, null, null, '1999' from {M} where o_year='1997'"),
    "q_with_insert": (_filled("with c as (select * from orders_m where o_ym = '199603') insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from c", "select * from {t}"), f"select o_orderkey, o_totalprice, o_ym, o_year from {M} where o_ym='199603'"),
    "q_multi_insert": (_filled("from orders_m insert into {t} select o_orderkey, o_totalprice, o_ym, o_year where o_year = '1996' insert into {t} select o_orderkey, 0, o_ym, o_year where o_year = '1997'", "select * from {t}"), f"select o_orderkey, case when o_year='1996' then o_totalprice else 0 end as o_totalprice, o_ym, o_year from {M} where o_year in ('1996','1997')"),
    "q_dynamic_conf": (_filled("insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m; insert overwrite table {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m where o_year = '1996' and o_totalprice < 100000", "select * from {t}", conf={"spark.sql.sources.partitionOverwriteMode": "dynamic"}), f"select o_orderkey, o_totalprice, o_ym, o_year from {M} where o_year<>'1996' or o_totalprice<100000"),
    "q_dynamic_option": (_filled("insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m; insert overwrite table {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m where o_year = '1996' and o_totalprice < 100000", "select * from {t}", options=", partitionoverwritemode 'DYNAMIC'"), f"select o_orderkey, o_totalprice, o_ym, o_year from {M} where o_year<>'1996' or o_totalprice<100000"),
    "q_delete_rows": (_filled("insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m; delete from {t} where o_year = '1996' and o_totalprice > 100000", "select * from {t}"), f"select o_orderkey, o_totalprice, o_ym, o_year from {M} where not (o_year='1996' and o_totalprice>100000)"),
    "q_update_rows": (_filled("insert into {t} select o_orderkey, o_totalprice, o_ym, o_year from orders_m; update {t} set o_totalprice = o_totalprice + 1 where o_ym = '199603'", "select * from {t}"), f"select o_orderkey, case when o_ym='199603' then o_totalprice+1 else o_totalprice end as o_totalprice, o_ym, o_year from {M}"),
    "q_names_dropped": (names_dropped, f"select count(*) as seen, false as left from {M} where o_year='1996'"),
    "q_stream_append": (streamed, f"select o_year, count(*) as n from {M} group by o_year"),
    "q_as_of_two_tables": (two_tables_as_of, f"select 2*count(*) as n, count(*) filter (where o_year='1996') * 2 as m, true as before from {M}"),
    "q_statistics": (statistics, f"select count(distinct o_year) as files, count(*) as n, true as sized from {M} where o_year<>'1997' or o_totalprice<100000"),
    "q_save_modes": (save_modes, f"select cast(i as integer) as i, mode, k*n as n, failed from (select count(*) as n from {M} where o_year='1996') cross join (values (0,'error',1,false),(1,'append',2,false),(2,'ignore',2,false),(3,'overwrite',1,false),(4,'error',1,true)) v(i,mode,k,failed)"),
    "q_formats": (formats, f"select kind, count(*) as n, cast(1 as bigint) as files from {M} cross join (values ('orc'),('json'),('csv')) v(kind) where o_year='1996' group by kind"),
    "q_subquery_pruned": (_counted("select o_orderkey from orders_m where o_year = '1996' and o_totalprice > (select avg(o_totalprice) from orders_m where o_ym = '199703')"), f"select count(*) as n, cast(2 as bigint) as files, (select count(distinct o_year) from {M}) as total from {M} where o_year='1996' and o_totalprice>(select avg(o_totalprice) from {M} where o_ym='199703')"),
    "q_chained_filter": (_counted("select o_orderkey, o_ym, o_totalprice from orders_m", "o_ym = '199603'", "o_totalprice < 50000"), f"select count(*) as n, cast(1 as bigint) as files, (select count(distinct o_year) from {M}) as total from {M} where o_ym='199603' and o_totalprice<50000"),
    "q_cte_pruned": (_counted("with c as (select o_custkey, o_year, rand() as r from orders_m where o_year in ('1995', '1996')) select x.o_custkey from c x join c y on x.o_custkey = y.o_custkey where y.o_year = '1996'"), f"select count(*) as n, cast(2 as bigint) as files, (select count(distinct o_year) from {M}) as total from {M} x join {M} y on x.o_custkey=y.o_custkey where x.o_year in ('1995','1996') and y.o_year='1996'"),
    "q_snapshots_projection": (_sql(SC5, "select numAddedFiles + numdDeletedFiles as changed from `orders_m$snapshots` where parentId <> -1"), f"with y as (select cast(count(distinct o_year) as integer) as c from {M}) select cast(v as integer) as changed from (select c as v from y union all select 3*c from y union all select 2 union all select 2) t"),
    "q_join_outer": (_sql(SC1, "select o.o_orderkey, l.l_linenumber from orders_m o full outer join (select * from lineitem where l_quantity > 45) l on o.o_orderkey = l.l_orderkey and o.o_year = '1996'"), f"select o.o_orderkey, l.l_linenumber from {M} o full outer join (select * from lineitem where l_quantity>45) l on o.o_orderkey=l.l_orderkey and o.o_year='1996'"),
    "q_join_theta": (_sql(SC1, "select count(*) as n from orders_m a join orders_m b on a.o_custkey = b.o_custkey and a.o_totalprice < b.o_totalprice where a.o_year = '1996'"), f"select count(*) as n from {M} a join {M} b on a.o_custkey=b.o_custkey and a.o_totalprice<b.o_totalprice where a.o_year='1996'"),
    "q_join_years": (_sql(SC1, "select x.o_year, y.o_year as other from (select distinct o_year from orders_m) x cross join (select distinct o_year from orders_m) y"), f"select x.o_year, y.o_year as other from (select distinct o_year from {M}) x cross join (select distinct o_year from {M}) y"),
    "q_join_range": (_sql(SC1, "select b.lo, count(*) as n from orders_m o join (select * from values (0D, 50000D), (50000D, 200000D), (200000D, 1e9D) as v(lo, hi)) b on o.o_totalprice >= b.lo and o.o_totalprice < b.hi group by b.lo"), f"select b.lo, count(*) as n from {M} o join (select cast(lo as double) as lo, cast(hi as double) as hi from (values (0,50000),(50000,200000),(200000,1000000000)) v(lo,hi)) b on o.o_totalprice>=b.lo and o.o_totalprice<b.hi group by b.lo"),
    "q_agg_cube": (_sql(SC1, "select o_year, o_orderstatus, count(*) as n from orders_m group by cube(o_year, o_orderstatus)"), f"select o_year, o_orderstatus, count(*) as n from {M} group by cube(o_year, o_orderstatus)"),
    "q_agg_grouping_sets": (_sql(SC1, "select o_year, o_orderpriority, count(distinct o_custkey) as n from orders_m group by grouping sets ((o_year), (o_orderpriority), ())"), f"select o_year, o_orderpriority, count(distinct o_custkey) as n from {M} group by grouping sets ((o_year), (o_orderpriority), ())"),
    "q_set_intersect": (_sql(SC1, "select o_custkey from orders_m where o_year = '1996' intersect select o_custkey from orders_m where o_year = '1997'"), f"select o_custkey from {M} where o_year='1996' intersect select o_custkey from {M} where o_year='1997'"),
    "q_scalar_functions": (_sql(SC1, "select o_orderkey, upper(o_orderpriority) as u, length(o_orderpriority) as l, coalesce(nullif(o_orderstatus, 'F'), '-') as s, case when o_totalprice > 1e5 then 1 else 0 end as c, year(o_orderdate) as y from orders_m where o_year = '1996'"), f"select o_orderkey, upper(o_orderpriority) as u, cast(length(o_orderpriority) as integer) as l, coalesce(nullif(o_orderstatus,'F'),'-') as s, cast(case when o_totalprice>1e5 then 1 else 0 end as integer) as c, cast(year(o_orderdate) as integer) as y from {M} where o_year='1996'"),
    "q_udf": (by_udf, f"select o_orderkey, o_totalprice*2 as x from {M} where o_year='1996'"),
    "q_join_managed_plain": (_sql(SC1, "select o.o_orderkey, l.l_linenumber from orders_m o join lineitem l on o.o_orderkey=l.l_orderkey where o.o_orderkey=77"), "select o.o_orderkey, l.l_linenumber from orders o join lineitem l on o.o_orderkey=l.l_orderkey where o.o_orderkey=77"),
    "q_join_semi": (_sql(SC1, "select o_orderkey from orders_m o where exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey and l.l_quantity>45)"), "select o_orderkey from orders o where exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey and l.l_quantity>45)"),
    "q_join_anti": (_sql(SC1, "select o_orderkey from orders_m o where not exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey)"), "select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey)"),
    "q_agg_rollup": (_sql(SC1, "select o_year, o_orderstatus, count(*) as n from orders_m group by rollup(o_year,o_orderstatus)"), f"select o_year, o_orderstatus, count(*) as n from {M} group by rollup(o_year,o_orderstatus)"),
    "q_distinct": (_sql(SC1, "select distinct o_orderpriority from orders_m"), "select distinct o_orderpriority from orders"),
    "q_window_rank": (_sql(SC1, "select o_orderkey, o_year, row_number() over (partition by o_year order by o_totalprice desc, o_orderkey) as r from orders_m"), f"select o_orderkey, o_year, cast(row_number() over (partition by o_year order by o_totalprice desc, o_orderkey) as integer) as r from {M}"),
    "q_topk": (_sql(SC1, "select o_orderkey, o_totalprice from orders_m order by o_totalprice desc, o_orderkey limit 10"), "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10"),
    "q_set_except": (set_except, f"select o_orderkey from {M} where o_year='1997' and o_totalprice>=100000"),
    "q_self_join_scans": (_sql(SC1, f"select count(*) as n from orders_m a join orders_m b on a.o_custkey=b.o_custkey where a.o_year='1996' and b.o_year='1997'"), f"select count(*) as n from {M} a join {M} b on a.o_custkey=b.o_custkey where a.o_year='1996' and b.o_year='1997'"),
    "q_subquery_unpruned": (_sql(SC1, f"{_COUNT} where o_year='1996' and o_totalprice>(select avg(o_totalprice) from orders_m where o_year='1997')"), f"select count(*) as n from {M} where o_year='1996' and o_totalprice>(select avg(o_totalprice) from {M} where o_year='1997')"),
    "q_self_overwrite": (_sql("append itself", "select * from orders_m"), f"select * from {M} where o_totalprice<200000"),
    "q_cte_union": (_sql(SC1, "with a as (select o_orderkey from orders_m where o_year='1995') select o_orderkey from a where o_orderkey<1000 union all select o_orderkey from orders_m where o_ym='199603'"), f"select o_orderkey from {M} where o_year='1995' and o_orderkey<1000 union all select o_orderkey from {M} where o_ym='199603'"),
}

QUERIES = {k: f for k, (f, _) in _ALL.items()}
ORACLES = {k: s for k, (_, s) in _ALL.items() if s is not None}
