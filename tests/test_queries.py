"""Every registered query of the reference's operators runs at the smallest scale; those with SQL agree with it."""

import math

import duckdb
import pytest

from lexflume.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(int(v))
    if isinstance(v, str):
        return v
    try:
        return f"{round(float(v), 6):.6f}"
    except (TypeError, ValueError):
        return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(cell(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name not in ORACLE_SQL:
        assert df.count() >= 0
        return
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())
