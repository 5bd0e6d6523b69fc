"""Latest row per key with a deterministic tie-break."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from strata.operators.dedupe import latest_per_key
from strata.operators.scd import apply_scd_type1, scd1
from tests import fixtures as fx

SCHEMA = StructType(
    [StructField("k", StringType()), StructField("ts", TimestampType()), StructField("v", StringType())]
)


def test_one_row_per_key_latest_wins(spark):
    df = fx.customers(spark, fx.NOOR_1, fx.NOOR_2, fx.PIET_1)
    out = {r.customer_id: r.revenue_ytd for r in latest_per_key(df, "customer_id", "updated_at").collect()}
    assert out == {"kt-204": 64_000.0, "kt-311": 14_300.0}


def test_empty(spark):
    assert latest_per_key(fx.customers(spark), "customer_id", "updated_at").count() == 0


def test_tie_break_is_greatest_row_digest(spark):
    ts = datetime(2024, 1, 1)
    values = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([("k", ts, v) for v in values], SCHEMA)
    digests = {v: hashlib.sha256(f"k||2024-01-01 00:00:00||{v}".encode()).hexdigest() for v in values}
    expected = max(values, key=lambda v: digests[v])
    (row,) = latest_per_key(df, "k", "ts").collect()
    assert row.v == expected


def test_winner_does_not_depend_on_partitioning(spark):
    ts = datetime(2024, 1, 1)
    rows = [(f"k{i % 7}", ts, f"v{i}") for i in range(200)]
    base = spark.createDataFrame(rows, SCHEMA)
    a = sorted(latest_per_key(base.repartition(1), "k", "ts").collect())
    b = sorted(latest_per_key(base.repartition(13, "v"), "k", "ts").collect())
    assert a == b and len(a) == 7


def test_null_order_loses_and_null_keys_keep_one_row(spark):
    rows = [
        ("k", None, "x"),
        ("k", datetime(2020, 1, 1), "y"),
        ("n", None, "only-null-order"),
        (None, datetime(2020, 1, 1), "p"),
        (None, datetime(2021, 1, 1), "q"),
    ]
    out = {r.k: r.v for r in latest_per_key(spark.createDataFrame(rows, SCHEMA), "k", "ts").collect()}
    assert out == {"k": "y", "n": "only-null-order", None: "q"}


def test_scd1_keeps_latest_per_customer(spark):
    df = fx.customers(spark, fx.NOOR_1, fx.NOOR_2, fx.PIET_1)
    out = apply_scd_type1(df)
    assert out.count() == 2 == out.select("customer_id").distinct().count()
    assert out.filter(F.col("customer_id") == "kt-204").collect()[0].revenue_ytd == 64_000.0
    assert scd1(fx.customers(spark)).count() == 0


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("hot", datetime(2024, 1, 1 + i % 28), str(i)) for i in range(500)], SCHEMA)
    plan = fx.plan_text(latest_per_key(df, "k", "ts"), "simple")
    # parents are printed first: Final limit, then the Exchange, then the Partial limit
    final, exchange, partial = plan.find("Final"), plan.find("Exchange hashpartitioning(k"), plan.find("Partial")
    assert 0 <= final < exchange < partial


def test_null_token_keeps_null_positions_apart(spark):
    from strata.functions.columns import row_digest

    schema = StructType([StructField(c, StringType()) for c in ("c1", "c2", "c3")])
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b")], schema)
    rows = df.select(
        F.concat_ws("||", "c1", "c2", "c3").alias("plain"),
        row_digest(["c1", "c2", "c3"]).alias("digest"),
    ).collect()
    assert [r.plain for r in rows] == ["a||b", "a||b", "a||||b"]
    assert len({r.digest for r in rows}) == 3
    expected = hashlib.sha256("a||__NULL__||b".encode()).hexdigest()
    assert rows[0].digest == expected
