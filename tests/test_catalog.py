"""Every catalog query against its SQL oracle on DuckDB (sf0.001 test tables)."""

from __future__ import annotations

import math
import os

import pandas as pd
import pytest

import __spark_entry__ as E
from strata.plans import catalog

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "nation", "orders", "region"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if v is None or v is pd.NaT or (not isinstance(v, (str, bytes)) and pd.isna(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, (int, float)) or type(v).__module__ == "numpy":
        f = float(v)
        return None if math.isnan(f) else f
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    got = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    want = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert _canon(got) == _canon(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "is_current" in df.columns
