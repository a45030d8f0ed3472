"""Every registered query that has SQL, against DuckDB on the smallest given tables."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, datetime):
        return v.strftime("%Y-%m-%d")
    return v.isoformat() if isinstance(v, date) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, str(SF))
    want = sql.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    key = lambda rows: sorted(tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in rows)
    assert key(map(tuple, got.select(cols).collect())) == key(want.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
