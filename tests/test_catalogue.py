"""Every query of the engine against its SQL on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from spatialfeat.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple(map(str, r)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = df.select(columns).collect()
    made = duck.sql(SQL[name])
    assert sorted(made.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    assert ordered(got) == ordered(duck.sql(f"SELECT {names} FROM ({SQL[name]})").fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
