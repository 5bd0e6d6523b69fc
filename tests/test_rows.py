"""Filters and enrichments (narrow operators)."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from strata.operators.rows import (
    filter_active_customers,
    filter_active_users,
    filter_valid_customers,
    keep_active,
    silver_customers,
    with_full_name,
    with_revenue_tier,
)
from tests import fixtures as fx


def test_active_users_keeps_three_of_five(spark):
    out = filter_active_users(fx.users(spark))
    assert out.count() == 3
    assert out.filter(~F.col("is_active")).count() == 0


def test_active_filter_drops_null_flag(spark):
    df = fx.users(spark, [("1", "A", "B", "US", None), ("2", "C", "D", "US", True)])
    assert [r.id for r in keep_active(df).collect()] == ["2"]


def test_active_filter_empty(spark):
    assert filter_active_users(fx.users(spark, [])).count() == 0


@pytest.mark.parametrize(("row_id", "country"), [("u-03", "MA"), ("u-11", "BE"), ("u-15", "BE")])
def test_active_rows_keep_their_values(spark, row_id, country):
    row = filter_active_users(fx.users(spark)).filter(F.col("id") == row_id).collect()[0]
    assert row.country == country and row.is_active is True


def test_valid_customers_drop_null_key_and_null_timestamp(spark):
    df = fx.customers(spark, fx.NOOR_1, fx.UNNAMED_1, fx.INES_UNDATED)
    out = filter_valid_customers(df).collect()
    assert [r.customer_id for r in out] == ["kt-204"]


def test_active_customers(spark):
    df = fx.customers(spark, fx.NOOR_1, fx.PIET_AWAY_1, fx.INES_1, fx.TOMAS_1, fx.AINO_AWAY_1)
    assert filter_active_customers(df).count() == 3


@pytest.mark.parametrize(
    ("first", "last", "expected"),
    [
        ("Noor", "Haddad", "Noor Haddad"),
        ("Ines", "Moreau", "Ines Moreau"),
        (None, "Haddad", "Haddad"),
        ("Noor", None, "Noor"),
        (None, None, ""),
    ],
)
def test_full_name(spark, first, last, expected):
    df = fx.users(spark, [("x", first, last, "US", True)])
    assert with_full_name(df).collect()[0].full_name == expected


@pytest.mark.parametrize(
    ("revenue", "tier"),
    [
        (131_000.0, "Platinum"),
        (100_000.0, "Platinum"),
        (61_250.5, "Gold"),
        (50_000.0, "Gold"),
        (25_000.0, "Silver"),
        (10_000.0, "Silver"),
        (9_999.99, "Bronze"),
        (5_000.0, "Bronze"),
        (None, "Bronze"),
        (math.nan, "Platinum"),
    ],
)
def test_revenue_tier(spark, revenue, tier):
    row = fx.row("C1", ("A", "B"), ("US", "NYC"), "Retail", revenue, fx.T1)
    assert with_revenue_tier(fx.customers(spark, row)).collect()[0].revenue_tier == tier


def test_custom_tier_bounds(spark):
    row = fx.row("C1", ("A", "B"), ("US", "NYC"), "Retail", 500.0, fx.T1)
    out = with_revenue_tier(fx.customers(spark, row), bounds=(1000,), labels=("High", "Low"))
    assert out.collect()[0].revenue_tier == "Low"
    with pytest.raises(ValueError):
        with_revenue_tier(fx.customers(spark, row), bounds=(1000,), labels=("High",))


def test_silver_filters_reach_the_parquet_scan(spark, scratch):
    df = fx.customers(spark, fx.NOOR_1, fx.PIET_AWAY_1, fx.UNNAMED_1, fx.INES_UNDATED)
    df.write.parquet(f"{scratch}/c")
    silver = silver_customers(spark.read.parquet(f"{scratch}/c"))
    plan = fx.plan_text(silver)
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for f in ("IsNotNull(customer_id)", "IsNotNull(updated_at)", "EqualTo(is_active,true)"):
        assert f in pushed
    assert [r.customer_id for r in silver.collect()] == ["kt-204"]
    assert set(silver.columns) >= {"full_name", "revenue_tier"}


def test_valid_and_active_customer_filters_on_empty_input(spark):
    empty = fx.customers(spark)
    assert filter_valid_customers(empty).count() == 0
    assert filter_active_customers(empty).count() == 0
    assert silver_customers(empty).count() == 0
