"""Every query with SQL against DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tessera.plans.reports import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    rows = got.collect()
    if name not in SQL:
        assert got.columns
        return
    want = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(map(repr, ([plain(r[c]) for c in columns] for r in rows))) == sorted(map(repr, ([plain(r[i]) for i in at] for r in want.fetchall())))
