"""A key holding about a third of all rows: results still equal the SQL formulation."""

from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.operators.rows import silver_customers
from strata.operators.scd import empty_dimension, scd2_merge
from strata.plans import oracle as O
from strata.sources.tables import EXTRACTED_AT, customer_states
from tests.test_catalog import _canon

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

HOT_UNTIL = "1997-03-01 00:00:00"  # orders run from 1995-01 to 2001-08: about a third before this


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("customer", "nation", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    hot = O.STATES.replace(
        "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id",
        f"CASE WHEN o_orderdate < TIMESTAMP '{HOT_UNTIL}' THEN 'HOT' "
        "WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id",
    )
    con.execute(f"CREATE VIEW hot_states AS {hot}")
    return con


def _hot_states(spark):
    states = customer_states(spark, SF, with_extract_date=True)
    hot = F.col(EXTRACTED_AT) < F.lit(HOT_UNTIL).cast("timestamp_ntz")
    return states.withColumn("customer_id", F.when(hot, F.lit("HOT")).otherwise(F.col("customer_id")))


def _pdf(df):
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)


def test_share_of_the_hot_key(spark):
    states = _hot_states(spark)
    share = states.filter(F.col("customer_id") == "HOT").count() / states.count()
    assert 0.25 < share < 0.4


def test_latest_per_key_with_hot_key(spark, duck):
    states = _hot_states(spark).drop(EXTRACTED_AT).repartition(16)
    got = _pdf(latest_per_key(states, "customer_id", "updated_at"))
    want = duck.execute(O.latest(f"(SELECT {O.cols(O.SRC)} FROM hot_states)", O.SRC)).fetchdf()
    assert _canon(got) == _canon(want)


def test_scd2_with_hot_key(spark, duck):
    states = _hot_states(spark)
    early = F.col(EXTRACTED_AT) < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    s1 = silver_customers(states.filter(early).drop(EXTRACTED_AT)).repartition(16)
    s2 = silver_customers(states.drop(EXTRACTED_AT)).repartition(16)
    got = _pdf(scd2_merge(scd2_merge(empty_dimension(s1), s1), s2))

    q = O.Sql()
    r1 = q.add("r1", f"SELECT {O.cols(O.SRC)} FROM hot_states WHERE extracted_at < TIMESTAMP '1998-01-01 00:00:00'")
    r2 = q.add("r2", f"SELECT {O.cols(O.SRC)} FROM hot_states")
    v1, v2 = q.add("v1", O.silver(r1)), q.add("v2", O.silver(r2))
    m1 = q.merge("m1", q.empty_dim(v1, O.SILVER), v1, O.SILVER)
    m2 = q.merge("m2", m1, v2, O.SILVER)
    want = duck.execute(q.render(f"SELECT * FROM {m2}")).fetchdf()
    assert _canon(got) == _canon(want)
    assert (got["customer_id"] == "HOT").sum() >= 1
