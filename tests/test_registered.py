"""Every registered query on the smallest tables against its SQL in DuckDB."""

import datetime as dt
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in row) for row in df.select(columns).collect())
    if name not in SQL:
        assert got
        return
    found = oracle.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in at) for row in found.fetchall())


def test_entry(spark):
    rows = entry_point.entry(spark).orderBy("batch_index").collect()
    assert [r["status"] for r in rows] == ["duplicate", *["accepted"] * 9]
    assert [r["token"] for r in rows] == ["events-1", *(f"events-1-{i}" for i in range(1, 10))]
    assert {r["rows"] for r in rows} == {100}


def test_no_registered_query_is_without_a_table():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) >= 45
