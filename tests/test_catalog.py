"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import normal

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="given tables not found")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, str(FOLDER))
    got = normal([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == normal(result.fetchall(), columns)
