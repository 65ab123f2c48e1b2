"""Every bar query against its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from lodebar.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted(([str(plain(r[i])) for i in order] for r in values))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    cursor = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    want = rows(columns, cursor.fetchall())
    mine = rows(got.columns, [tuple(r) for r in got.collect()])
    clean = lambda table: [[x.removesuffix(".0") for x in r] for r in table]
    assert clean(mine) == clean(want)


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
