"""Every query with SQL gives the rows that DuckDB gives."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()


def rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def one(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        if isinstance(v, (list, tuple)):
            return tuple(map(one, v))
        return str(v) if not isinstance(v, (int, str, bool, type(None))) else v

    return Counter(tuple(one(t[i]) for i in order) for t in tuples)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, data, name):
    con = duckdb.connect()
    for p in glob.glob(data + "/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = con.sql(SQL[name])
    got = entry.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
