"""The entry module: queries and SQL fit together, and results are the same on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 4) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_queries_match_sql(spark):
    assert entry.entry(spark).count() > 0
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name in sorted(k for k in sql if k.startswith("q_")):
        df = queries[name](spark, SF)
        columns = sorted(df.columns)
        cursor = con.execute(sql[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == columns, name
        want = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
        assert sorted(repr([plain(r[c]) for c in columns]) for r in df.collect()) == want, name
