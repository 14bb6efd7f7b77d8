"""Every catalogue query against its SQL in DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from ledgerlark.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_matches_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    assert got == sorted(tuple(plain(dict(zip(rel.columns, row, strict=True))[c]) for c in columns) for row in rel.fetchall())


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
