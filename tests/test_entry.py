import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from regloom.session import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "RMSE" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is pd.NA:  # DuckDB's null in a nullable integer column
        return None
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = E.queries()[name](spark, SF).toPandas()
    d = con.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    cols = sorted(s.columns)
    rs = sorted((tuple(_norm(x) for x in r) for r in s[cols].itertuples(index=False)), key=repr)
    rd = sorted((tuple(_norm(getattr(x, "item", lambda: x)()) for x in r)
                 for r in d[cols].itertuples(index=False)), key=repr)
    assert rs == rd
