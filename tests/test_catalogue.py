"""Every catalogue query against its SQL in DuckDB, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

from tidewright.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return x


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_rows(spark, db, name):
    got = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    cur = db.execute(catalogue.SQL[name])
    want_cols = [c[0] for c in cur.description]
    assert sorted(want_cols) == cols
    at = [want_cols.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    have = sorted((tuple(plain(x) for x in r) for r in got.select(*cols).collect()), key=repr)
    assert have == want
