"""Every registered query of the engine against its DuckDB SQL on the driver's smallest tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

from crosslane.registry import ORACLE_SQL, QUERIES

from .conftest import DATA


def plain(x):
    if isinstance(x, float | decimal.Decimal):
        return f"{float(x):.6g}"
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    ours = sorted(str(tuple(plain(r[c]) for c in columns)) for r in got.collect())
    assert ours == sorted(str(tuple(plain(r[i]) for i in at)) for r in want.fetchall())
