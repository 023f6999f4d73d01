"""Every registered query with SQL gives the same rows as DuckDB, outside the llm subpackage."""

import os

import duckdb
import pandas as pd
import pytest

from folioframe.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "null"
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted("|".join(map(cell, r)) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_against_duckdb(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
