"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from eventide import registry
from eventide.sources.driver import TABLES
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "event_type", "event_count", "unique_users"]
    assert df.count() > 0


def test_every_library_query_has_an_oracle():
    assert set(registry.QUERIES) <= set(QUERIES)
    assert set(registry.QUERIES) == set(registry.ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    od = con.execute(ORACLE[name]).fetchdf()
    assert sorted(sp.columns) == sorted(od.columns)
    assert _rows(sp) == _rows(od)
