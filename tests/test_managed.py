"""Managed tables: the walkthrough, commits in conflict, pruning that never loses a row, transforms, SQL."""

import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.transforms import Transform, hashed, murmur3
from tidemark.functions.types import UnsupportedTypeError, comparable, field_ids, storage_type
from tidemark.operators.table import ManagedTable, ValidationError
from tidemark.plans.predicates import FALSE, TRUE, And, Not, Or, Pred, Stats, expanded, may_match, negated, pushed
from tidemark.plans.session import ManagedSession
from tidemark.sources.store import CommitFailed
from tidemark.streaming.sink import append_stream

DAYS = ["0905245", "0906245", "0907245", "0908245", "0909245", "1001245"]
DDL = """create table if not exists {name} (ss_item_sk int, ss_quantity int, ss_sales_price decimal(7,2),
 ss_sold_month string, ss_sold_day string, ss_sold_date_sk string) using parquet
 options (addTableManagement "true", columnDependencies "ss_sold_date_sk=ss_sold_month:truncate[2],ss_sold_date_sk=ss_sold_day:truncate[4]")
 partitioned by (ss_sold_date_sk)"""


def sales(spark):
    """2109 rows in six days; 236 in 0906245; 232 of 0905245 with item 5000 or more."""
    counts = dict(zip(DAYS, [500, 236, 400, 400, 300, 273]))
    rows = []
    for day, n in counts.items():
        for i in range(n):
            item = 5000 + i if day == "0905245" and i < 232 else i + 1
            rows.append((item, i % 7, Decimal(i) / 4, day[:2], day[:4], day))
    return spark.createDataFrame(rows, "ss_item_sk int, ss_quantity int, ss_sales_price decimal(7,2), ss_sold_month string, ss_sold_day string, ss_sold_date_sk string").repartition(5)


@pytest.fixture
def session(spark, tmp_path):
    return ManagedSession(spark, f"file://{tmp_path}")


def count(df):
    return df.first()[0]


def test_walkthrough(spark, session):
    sales(spark).createOrReplaceTempView("store_sales")
    session.sql(DDL.format(name="out"))
    assert session.sql("select * from `out$snapshots`").count() == 0
    assert session.sql("select * from out").count() == 0
    n = "select count(*) from out"
    insert = "insert into out select * from store_sales"
    session.sql(insert)
    assert count(session.sql(n)) == 2109
    assert session.table("out").snapshots().first()["parentId"] == -1
    assert count(session.sql(f"{n} where ss_sold_date_sk = '0906245'")) == 236
    read, total, predicate = session.last_plan["out"]
    assert read < total and "ss_sold_month eq '09'" in str(predicate)
    session.sql(insert)
    assert count(session.sql(n)) == 4218
    times = [s["time"] for s in session.table("out").metadata["snapshots"]]
    first = dt.datetime.fromtimestamp(times[0] / 1000, dt.UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
    assert count(session.sql(f"AS OF '{first}' {n}")) == 2109
    session.sql("insert overwrite table out select * from store_sales")
    assert count(session.sql(n)) == 2109
    last = session.sql("select * from `out$snapshots` where numdDeletedFiles > 0").first()
    assert last["numdDeletedFiles"] == 2 * last["numAddedFiles"]
    session.sql("insert overwrite table out partition (ss_sold_date_sk = '0906245') select ss_item_sk, ss_quantity, ss_sales_price, ss_sold_month, ss_sold_day from store_sales where ss_sold_date_sk = '0906245'")
    assert count(session.sql(n)) == 2109
    session.sql("insert overwrite table out partition (ss_sold_date_sk = '0905245') select ss_item_sk, ss_quantity, ss_sales_price, ss_sold_month, ss_sold_day from store_sales where ss_sold_date_sk = '0905245' and ss_item_sk < 5000")
    assert count(session.sql(n)) == 1877
    assert count(session.sql(f"-- a comment\nAS OF '{first}' {n}")) == 2109
    assert session.sql("select * from out where ss_item_sk > 5000 and ss_sold_date_sk = '0905245'").count() == 0
    assert session.last_plan["out"][0] == 0
    assert count(session.sql(f"AS OF '{times[1]}' {n}")) == 4218
    assert count(session.sql(f"as of '{times[0] - 1000}' {n}")) == 1877
    joined = session.sql("select count(*) from out a join store_sales b on a.ss_item_sk = b.ss_item_sk where a.ss_sold_date_sk = '0906245'")
    assert count(joined) > 0
    with pytest.raises(ValueError, match="neither a timestamp"):
        session.sql(f"AS OF 'yesterdayish' {n}")
    strict = ManagedSession(spark, session.warehouse, strict_as_of=True)
    strict.register("out", session.table("out").root)
    with pytest.raises(LookupError):
        strict.sql(f"AS OF '0' {n}")


def test_statements(spark, session):
    sales(spark).createOrReplaceTempView("store_sales")
    with pytest.raises(ValidationError, match="no partition columns"):
        session.sql("create table bad (a int) using parquet options (addTableManagement 'true')")
    with pytest.raises(ValidationError, match="does not exist"):
        session.sql("create table bad (a int, p string) using parquet options (addTableManagement 'true', columnDependencies 'p=zz:truncate[2]') partitioned by (p)")
    with pytest.raises(ValidationError, match="does not apply"):
        session.sql("create table bad (a int, p string) using parquet options (addTableManagement 'true', columnDependencies 'p=a:extract[2]') partitioned by (p)")
    with pytest.raises(ValueError, match="not true or false"):
        session.sql("create table bad (a int, p string) using parquet options (addTableManagement 'yes') partitioned by (p)")
    session.sql("create table made using parquet options (addTableManagement 'true') partitioned by (ss_sold_date_sk) as select ss_item_sk, ss_sold_date_sk from store_sales")
    assert session.table("made").snapshots().count() == 1
    session.sql("create table if not exists made (a int, p string) using parquet options (addTableManagement 'true') partitioned by (p)")
    assert session.sql("select * from made").columns == ["ss_item_sk", "ss_sold_date_sk"]
    with pytest.raises(FileExistsError):
        session.sql("create table made (a int, p string) using parquet options (addTableManagement 'true') partitioned by (p)")
    session.sql("insert overwrite table made partition (ss_sold_date_sk = '0906245') if not exists select 1")
    assert count(session.sql("select count(*) from made")) == 2109
    session.sql("insert into made partition (ss_sold_date_sk = 'new') with t as (select 7 as x) select x from t")
    assert session.sql("select ss_item_sk from made where ss_sold_date_sk = 'new'").first()[0] == 7
    assert session.sql("with m as (select * from made) select count(*) from m a join made b using (ss_item_sk) where a.ss_sold_date_sk = 'new'").first()[0] > 0
    assert session.sql("select 1 as one").first()[0] == 1


def test_modes_and_partial_partitions(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, p string, q int")
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", schema, ["p", "q"])
    rows = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "y", 1), (4, None, 1), (5, "a/b=c d", 1)], schema)
    assert t.insert(rows, "ignore") is not None and t.insert(rows, "ignore") is None
    with pytest.raises(FileExistsError):
        t.insert(rows, "error")
    with pytest.raises(ValueError):
        t.insert(rows, "sometimes")
    assert sorted(t.partitions().collect(), key=str) == sorted(rows.select("p", "q").collect(), key=str)
    t.overwrite(spark.createDataFrame([(9, 7)], "a int, q int"), {"p": "x"})
    assert sorted(r["a"] for r in t.scan().collect()) == [3, 4, 5, 9]
    t.overwrite(spark.createDataFrame([(8, "y", 1)], schema), dynamic=True)
    assert sorted(r["a"] for r in t.scan().collect()) == [4, 5, 8, 9]
    assert [r["a"] for r in t.scan("p is null").collect()] == [4]
    assert [r["a"] for r in t.scan("p = 'a/b=c d'").collect()] == [5]
    with pytest.raises(ValueError, match="takes 3 columns"):
        t.append(rows.select("a", "p"))
    with pytest.raises(ValueError, match="not partition columns"):
        t.append(rows, {"a": "1"})
    before = t.version
    assert t.append(rows.where("1 = 0")) is None and t.version == before
    assert t.expire_snapshots(1 << 60) == len(rows.columns) - 0 - 1 and t.scan().count() == 4
    assert t.snapshots().count() == 1


def test_commits_in_conflict(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, p string")
    root = f"file://{tmp_path}/t"
    one = ManagedTable.create(spark, root, schema, ["p"])
    rows = spark.createDataFrame([(1, "x")], schema)
    one.append(rows)
    two = ManagedTable(spark, root)
    one.append(rows)
    two.append(rows)  # on top of the other
    assert two.scan().count() == 3 and two.metadata["snapshots"][-1]["parent"] == two.metadata["snapshots"][-2]["id"]
    stale = ManagedTable(spark, root)
    old = stale.matching({"p": "x"})
    two.overwrite(rows)
    with pytest.raises(CommitFailed):
        stale.commit([], old)
    times = [s["time"] for s in two.metadata["snapshots"]]
    assert times == sorted(set(times))


def test_verified_dependencies(spark, tmp_path):
    schema = T.StructType.fromDDL("m string, p string")
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", schema, ["p"], "p=m:truncate[2]", verify_dependencies=True)
    t.append(spark.createDataFrame([("09", "0905")], schema))
    with pytest.raises(ValueError, match="break the column dependency"):
        t.append(spark.createDataFrame([("10", "0905")], schema))


TYPES = "b boolean, i8 tinyint, i32 int, i64 bigint, f float, d double, s string, dt date, ts timestamp, tsn timestamp_ntz, d92 decimal(9,2), bin binary, arr array<int>, st struct<x:int,y:string>, p string"


def typed_rows(seed, n=60):
    r = random.Random(seed)
    maybe = lambda v: None if r.random() < 0.15 else v
    out = []
    for _ in range(n):
        day = dt.date(1960, 1, 1) + dt.timedelta(r.randrange(30000))
        at = dt.datetime(1969, 12, 30) + dt.timedelta(seconds=r.randrange(400000), microseconds=r.randrange(10**6))
        number = r.choice([r.uniform(-5, 5), float("nan"), float("inf"), float("-inf"), 0.0])
        out.append((maybe(r.random() < 0.5), maybe(r.randrange(-9, 9)), maybe(r.randrange(-99, 99)), maybe(r.randrange(-(10**12), 10**12)), maybe(float(r.randrange(-8, 8)) / 4), maybe(number), maybe(r.choice(["", "a", "ab", "é", "zz", "Z"])), maybe(day), maybe(at.replace(tzinfo=dt.UTC)), maybe(at), maybe(Decimal(r.randrange(-9999, 9999)) / 100), maybe(b"\x00x"), maybe([1, None]), maybe((1, "y")), maybe(r.choice(["k1", "k2", "k 3"]))))
    return out


PREDICATES = ["b", "not b", "i8 >= 3", "i32 < -50", "5 > i32", "i64 <=> 7", "not (i64 <=> 7)", "f in (0.25, 1.5)", "d > 3", "d < 0", "d = double('NaN')", "d >= double('Infinity')", "not (d < 1)", "s = ''", "s > 'a'", "s like 'a%'", "not (s like 'a%')", "s <> 'ab'", "dt < date '1970-01-01'", "ts >= timestamp '1970-01-01 00:00:00'", "tsn = timestamp_ntz '1970-01-01 10:00:00'", "d92 <= -12.34", "d92 is null", "p is null", "p = 'k1' and i8 < 0", "p in ('k2', 'k 3') or i32 > 90", "not (p = 'k1' or i32 > 0)", "s is not null and not (i8 is null)", "i32 % 3 = 1 and i8 > 0", "coalesce(p, 'z') = 'z'", "i32 not in (1, 2, 3)", "1 = 0", "st.x = 1"]


def test_pruning_loses_no_row(spark, tmp_path):
    schema = T.StructType.fromDDL(TYPES)
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", schema, ["p"])
    for seed in range(4):
        t.append(spark.createDataFrame(typed_rows(seed), schema).orderBy(["i32", "dt", "d", "s"][seed]).repartitionByRange(4, ["i32", "dt", "d", "s"][seed]))
    whole = spark.createDataFrame([r for seed in range(4) for r in typed_rows(seed)], schema).repartition(2)
    assert t.scan().count() == 240
    for where in PREDICATES:
        plan = t.plan(where)
        assert t.scan(where).count() == whole.where(where).count(), where
        assert len(plan.files) <= plan.total
    assert len(t.plan("i32 < -90").files) < len(t.plan().files) and not t.plan("1 = 0").files


def test_random_trees():
    r = random.Random(3)

    def tree(depth):
        if depth == 0 or r.random() < 0.2:
            return Pred(r.choice(["lt", "le", "gt", "ge", "eq", "ne", "nseq", "not_nseq"]), "c", r.randrange(6)) if r.random() < 0.8 else Pred(r.choice(["is_null", "not_null"]), "c")
        return r.choice([lambda: Not(tree(depth - 1)), lambda: And(tree(depth - 1), tree(depth - 1)), lambda: Or(tree(depth - 1), tree(depth - 1))])()

    for _ in range(400):
        p = pushed(tree(3))
        values = [r.choice([None, *range(6)]) for _ in range(r.randrange(1, 5))]
        known = [v for v in values if v is not None]
        stats = Stats(len(values), values.count(None), min(known, default=None), max(known, default=None))
        some = any(may_match(p, {"c": v}, lambda c: None) for v in values)
        assert may_match(p, {}, lambda c: stats) or not some
    assert negated(TRUE) is FALSE and (TRUE & FALSE) is FALSE


def test_hashes_and_transforms(spark):
    assert [hashed(34, T.LongType()), hashed("hello", T.StringType()), hashed(Decimal("14.20"), T.DecimalType(9, 2)), murmur3(bytes([0, 1, 2, 3]))] == [2017239379, 613153351, -500754589, -188683207]
    assert hashed(comparable(dt.date(2017, 11, 16), T.DateType()), T.DateType()) == -653330422
    assert hashed(comparable(dt.datetime(2017, 11, 16, 22, 31, 8), T.TimestampNTZType()), T.TimestampNTZType()) == -2047944441
    rows = spark.createDataFrame(typed_rows(9, 40), T.StructType.fromDDL(TYPES))
    for text, column in [("truncate[2]", "s"), ("truncate[10]", "i64"), ("truncate[25]", "d92"), ("bucket[7]", "s"), ("bucket[7]", "i64"), ("bucket[5]", "dt"), ("year", "dt"), ("month", "ts"), ("day", "tsn"), ("hour", "ts"), ("hour", "tsn"), ("identity", "i32")]:
        kind = rows.schema[column].dataType
        t = Transform(text, kind)
        for r in rows.select(F.col(column).alias("v"), t.column(F.col(column)).alias("w")).collect():
            assert t.value(comparable(r["v"], kind)) == comparable(r["w"], t.result), (text, column, r)
    for bad in [("extract[2]", T.StringType()), ("truncate", T.StringType()), ("year", T.StringType()), ("hour", T.DateType()), ("bucket[0]", T.LongType())]:
        with pytest.raises(ValueError):
            Transform(*bad)


def test_projections_are_sound():
    r = random.Random(5)
    for text, kind, draw in [("truncate[10]", T.LongType(), lambda: r.randrange(-50, 50)), ("truncate[2]", T.StringType(), lambda: "".join(r.choice("ab") for _ in range(r.randrange(5)))), ("month", T.DateType(), lambda: r.randrange(-400, 400)), ("bucket[3]", T.LongType(), lambda: r.randrange(9))]:
        t = Transform(text, kind)
        for _ in range(500):
            x, v, op = draw(), draw(), r.choice(["lt", "le", "gt", "ge", "eq", "ne", "nseq"])
            holds = may_match(Pred(op, "c", v), {"c": x}, lambda c: None)
            if (q := t.project(op, v)) and holds:
                assert may_match(Pred(q[0], "c", q[1]), {"c": t.value(x)}, lambda c: None), (text, op, x, v)
            if (q := t.project_strict(op, v)) and may_match(Pred(q[0], "c", q[1]), {"c": t.value(x)}, lambda c: None):
                assert holds, (text, op, x, v)
    from tidemark.plans.predicates import Dependency

    d = Dependency("a", "b", Transform("truncate[2]", T.StringType()))
    assert expanded(Pred("eq", "a", "0906"), [d]) == And(Pred("eq", "a", "0906"), Pred("eq", "b", "09"))
    assert expanded(Pred("ne", "a", "0906"), [d]) == Pred("ne", "a", "0906")


def test_types():
    ids = field_ids(T.StructType.fromDDL("a int, s struct<x:int,m:map<string,int>>, l array<struct<y:int>>"))
    assert ids == {"a": 0, "s": 1, "s.x": 2, "s.m": 3, "s.m.key": 4, "s.m.value": 5, "l": 6, "l.element": 7, "l.element.y": 8}
    assert storage_type(T.ShortType()) == "int" and storage_type(T.DecimalType(7, 2)) == "decimal(7,2)"
    with pytest.raises(UnsupportedTypeError):
        storage_type(T.DayTimeIntervalType())


def test_other_formats(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, p string")
    for kind in ("orc", "json", "csv"):
        t = ManagedTable.create(spark, f"file://{tmp_path}/{kind}", schema, ["p"], file_format=kind)
        t.append(spark.createDataFrame([(1, "x"), (2, "x y"), (3, None)], schema))
        assert sorted(r["a"] for r in t.scan("p <> 'x' or p is null").collect()) == [2, 3]
        assert sum(r["record_count"] for r in t.files().collect()) == 3


def test_many_files_read_by_tasks(spark, tmp_path, monkeypatch):
    from tidemark.sources import metrics

    monkeypatch.setattr(metrics, "DRIVER_FILES", 2)
    schema = T.StructType.fromDDL("a int, p string")
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", schema, ["p"])
    t.append(spark.range(20).selectExpr("cast(id as int) as a", "cast(id % 5 as string) as p"))
    assert sum(e["rows"] for e in t.entries(t.snapshot())) == 20 and not t.plan("a > 19").files


def test_stream(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, p string")
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", schema, ["p"])
    spark.createDataFrame([(1, "x"), (2, "y")], schema).write.parquet(f"{tmp_path}/in/1")
    for _ in range(2):
        q = append_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"), t, f"{tmp_path}/check-{uuid.uuid4().hex[:0]}").trigger(availableNow=True).start()
        q.awaitTermination()
    t.refresh()
    assert t.scan().count() == 2 and t.snapshots().count() == 1


def test_manifests_are_pruned(spark, tmp_path, monkeypatch):
    from tidemark.sources import store

    monkeypatch.setattr(store, "MANIFEST_FILES", 2)
    schema = T.StructType.fromDDL("a int, p string")
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", schema, ["p"])
    rows = spark.range(60).selectExpr("cast(id as int) as a", "case when id % 6 = 5 then null else concat('k', id % 6) end as p").repartition(1)
    t.append(rows)
    manifests = t.manifests(t.snapshot())
    assert len(manifests) == 3 and sum(m["files"] for m in manifests) == t.plan().total == 6
    fresh = ManagedTable(spark, t.root)
    plan = fresh.plan("p = 'k3'")
    assert len(plan.files) == 1 and plan.total == 6 and sum("manifest-" in p for p in fresh.store.cache) <= 2  # one for the probe
    assert fresh.scan("p = 'k3' and a > 30").count() == 5 and fresh.scan("p is null").count() == 10
    assert not ManagedTable(spark, t.root).plan("a > 59").files
    t.overwrite(rows.where("p = 'k3' and a < 10"), {"p": "k3"})
    after = t.manifests(t.snapshot())
    assert len({m["path"] for m in manifests} & {m["path"] for m in after}) == 2 and t.scan().count() == 52  # 60 - 10 + 2
    t.overwrite(spark.createDataFrame([(1, None)], schema), dynamic=True)
    assert t.scan("p is null").count() == 1 and t.scan().count() == 43
    t.overwrite(rows.limit(0))
    assert t.scan().count() == 0 and t.plan("a > 1").total == 0


def test_manifest_bounds_lose_no_row(spark, tmp_path, monkeypatch):
    from tidemark.sources import store

    monkeypatch.setattr(store, "MANIFEST_FILES", 3)
    schema = T.StructType.fromDDL(TYPES)
    for by in ("p", "i32", "d"):
        t = ManagedTable.create(spark, f"file://{tmp_path}/{by}", schema, [by])
        whole = spark.createDataFrame(typed_rows(11), schema)
        t.append(whole.repartition(1))
        for where in PREDICATES:
            assert t.scan(where).count() == whole.where(where).count(), (by, where)
    rest = whole.where("not (d <=> double('NaN'))").count()
    t.overwrite(whole.limit(0).drop("d"), {"d": "NaN"})
    assert t.scan().count() == rest < whole.count()


def test_names_of_two_parts(spark, session):
    sales(spark).createOrReplaceTempView("store_sales")
    session.sql(DDL.format(name="db.out"))
    session.sql("insert into db.out select * from store_sales")
    assert count(session.sql("select count(*) from db.out where db.out.ss_sold_date_sk = '0906245' and 'db.out' = 'db.out'")) == 236
    assert session.last_plan["db.out"][0] < session.last_plan["db.out"][1]
    assert session.sql("select * from db.`out$snapshots`").count() == 1
    assert count(session.sql("select count(*) from `DB` . `out` x where x.ss_item_sk > 0")) == 2109
    session.sql("insert overwrite table db.out partition (ss_sold_date_sk = '0906245') select 1, 1, 1, '09', '0906'")
    assert count(session.sql("select count(*) from db.out -- db.out\n")) == 2109 - 235
    at = session.table("db.out").metadata["snapshots"][0]["time"]
    assert count(session.sql(f"AS OF '{at}' select count(*) from db.out")) == 2109
    session.sql(DDL.format(name="plainly"))
    session.sql("insert into default.plainly select * from db.out")
    assert count(session.sql("select count(*) from default.plainly")) == 2109 - 235


def test_commands_see_whole_tables(spark, session, tmp_path):
    sales(spark).createOrReplaceTempView("store_sales")
    session.sql(DDL.format(name="whole"))
    session.sql("insert into whole select * from store_sales")
    session.sql(f"insert overwrite directory '{tmp_path}/copy' using parquet select * from whole")
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 2109
    session.sql("create or replace temp view over_whole as select * from whole where ss_sold_day > ''")
    assert spark.table("over_whole").count() == 2109
    assert count(session.sql("select count(*) from whole where ss_item_sk > (select min(ss_item_sk) from whole)")) < 2109
    assert count(session.sql("with c as (select * from whole) select count(*) from c a left join c b on a.ss_item_sk = -b.ss_item_sk")) == 2109


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def small(session, name, options=""):
    session.sql(f"create table {name} (a int, b int, p string) using parquet options (addTableManagement 'true'{options}) partitioned by (p)")


def test_insert_finds_its_columns(spark, session):
    small(session, "t")
    session.sql("insert into t (b, a, p) values (1, 2, 'x')")
    session.sql("insert into t by name select 3 as b, 4 as a, 'y' as p")
    session.sql("insert into t (p, b) values ('z', 5)")
    session.sql("insert into t partition (p = 'x') (b, a) values (6, 7)")
    session.sql("insert into t partition (p = 'w') by name select 8 as b")
    assert rows_of(session.sql("select a, b, p from t")) == sorted([(2, 1, "x"), (4, 3, "y"), (None, 5, "z"), (7, 6, "x"), (None, 8, "w")], key=str)
    for bad, why in (("insert into t (b, a) select 1, 2, 3", "2 columns are named"), ("insert into t (b, b, p) values (1, 2, 'x')", "more than once"), ("insert into t (c) values (1)", "has no columns"), ("insert into t by name select 1 as c, 'x' as p", "has no columns"), ("insert into t partition (p = 'x') (p, a) values ('y', 1)", "have a value")):
        with pytest.raises(ValueError, match=why):
            session.sql(bad)


def test_insert_below_with_and_from(spark, session):
    small(session, "t")
    small(session, "u")
    session.sql("with c as (select 1 as x, 'p' as q) insert into t select x, x + 1, q from c")
    session.sql("from t insert into t select a + 10, b, p insert into u select a, b, 'u'")
    assert rows_of(session.sql("select a, b, p from t")) == [(1, 2, "p"), (11, 2, "p")]
    assert session.sql("select * from u").count() in (1, 2)


def test_overwrite_mode_of_the_session(spark, session):
    small(session, "t")
    small(session, "o", ", PARTITIONOVERWRITEMODE 'dynamic'")
    for t in "to":
        session.sql(f"insert into {t} values (1, 1, 'x'), (2, 2, 'y')")
    session.sql("insert overwrite table o select 9, 9, 'x'")
    assert rows_of(session.sql("select * from o")) == [(2, 2, "y"), (9, 9, "x")]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        session.sql("insert overwrite table t select 9, 9, 'x'")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows_of(session.sql("select * from t")) == [(2, 2, "y"), (9, 9, "x")]
    session.sql("insert overwrite table t select 7, 7, 'x'")
    assert rows_of(session.sql("select * from t")) == [(7, 7, "x")]


def test_names_are_shared_and_dropped(spark, session):
    small(session, "t")
    session.sql("insert into t values (1, 1, 'x')")
    other = ManagedSession(spark, session.warehouse)
    assert other.sql("select * from t").count() == 1
    root = other.table("t").root
    other.sql("drop table t")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        session.sql("select * from t").collect()
    assert not session.tables and not session.names.store.fs.exists(session.names.store.path(root))
    small(session, "t")
    assert other.sql("select * from t").count() == 0
    session.sql("drop table if exists t")
    session.sql("drop table if exists t")


def test_delete_and_update(spark, session):
    small(session, "t")
    session.sql("insert into t values (1, 1, 'x'), (2, null, 'x'), (3, 3, 'y')")
    session.sql("delete from t where b = 1")
    assert rows_of(session.sql("select * from t")) == [(2, None, "x"), (3, 3, "y")]
    session.sql("update t set b = a + 1, p = 'z' where t.a = 2")
    assert rows_of(session.sql("select * from t")) == [(2, 3, "z"), (3, 3, "y")]
    before = len(session.table("t").metadata["snapshots"])
    session.sql("delete from t where a > 100")
    assert len(session.table("t").metadata["snapshots"]) == before
    session.sql("delete from t")
    assert session.sql("select * from t").count() == 0
    with pytest.raises(NotImplementedError):
        session.sql("merge into t using t as s on t.a = s.a when matched then delete")


def test_later_filters_and_subqueries_prune(spark, session):
    small(session, "t")
    for p in "vwxyz":
        session.sql(f"insert into t values ({ord(p)}, 1, '{p}')")
    df = session.sql("select a, p from t")
    assert session.last_plan["t"][:2] == (5, 5)
    one = df.where("p = 'x'")
    assert session.last_plan["t"][:2] == (1, 5) and rows_of(one) == [(120, "x")]
    two = df.select((F.col("a") + 1).alias("c"), "p").filter(F.col("p") > "w").filter("c < 122")
    assert session.last_plan["t"][0] <= 3 and rows_of(two) == [(121, "x")]
    bound = df.where(df.p == "y")  # names this frame's own column
    assert rows_of(bound) == [(121, "y")]
    got = session.sql("select * from t where a = (select max(a) from t where p = 'w')")
    assert got.count() == 1
    session.sql("select count(*) from t where p = 'v' and a < (select max(a) from t where p = 'w')").collect()
    assert session.last_plan["t"][0] == 2
    session.sql("with c as (select *, rand() as r from t where p = 'v') select * from c x join c y on x.a = y.a").collect()
    assert session.last_plan["t"][0] == 1
    scan = session.table("t").scan()
    assert len(scan.inputFiles()) == 5 and len(scan.where("p = 'x'").inputFiles()) == 1
    pinned = session.sql("select * from t")
    session.sql("insert into t values (1, 1, 'x')")
    assert pinned.where("p = 'x'").count() == 1 and session.sql("select * from t where p = 'x'").count() == 2


def test_small_manifests_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.operators.table.SMALL_MANIFESTS", 3)
    t = ManagedTable.create(spark, f"file://{tmp_path}/t", T.StructType.fromDDL("a int, p string"), ["p"])
    for i in range(7):
        t.append(spark.createDataFrame([(i, f"k{i}")], "a int, p string"))
    assert len(t.manifests(t.snapshot())) <= 4 and t.scan().count() == 7
    assert t.scan(as_of=t.metadata["snapshots"][2]["time"]).count() == 3
    assert t.statistics()["rows"] == t.statistics()["files"] == 7
    assert len(t.plan("p = 'k3'").files) == 1


def test_bucket_columns_equal_values(spark):
    values = {"long": [0, 34, -1, 1 << 62, None], "int": [0, -5, None], "string": ["", "iceberg", "a\u00e9\U0001f600", "abcd", None], "date": [dt.date(2017, 11, 16), None], "timestamp_ntz": [dt.datetime(2017, 11, 16, 22, 31, 8), None], "decimal(9,2)": [Decimal("14.20"), Decimal("-1.00"), None], "binary": [b"\x00\x01\x02\x03", b"", None]}
    for kind, vs in values.items():
        df = spark.createDataFrame([(v,) for v in vs], f"v {kind}")
        t = Transform("bucket[100]", df.schema["v"].dataType)
        want = [None if v is None else t.value(comparable(v, df.schema["v"].dataType)) if kind != "binary" else t.value(v) for v in vs]
        assert [r[0] for r in df.select(t.column(F.col("v"))).collect()] == want, kind
