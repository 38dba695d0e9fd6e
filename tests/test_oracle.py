"""Every named query equals its DuckDB oracle on the smallest test tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "part", "orders"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _rows(got) == _rows(exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "cnt", "avg_temp", "window_end"]
    assert df.count() > 0
