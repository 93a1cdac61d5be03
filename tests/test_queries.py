"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from lakequeries import catalog
from tools.check_queries import TABLES, compare

SF = "/root/testdata/sf0.001"
SQL = catalog.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows, name
    cur = duck.execute(SQL[name])
    assert not compare(df.columns, rows, [c[0] for c in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
