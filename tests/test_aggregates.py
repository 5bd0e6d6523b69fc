"""Gold aggregates."""

from __future__ import annotations

import pytest

from strata.operators.aggregates import (
    count_by,
    revenue_by_country,
    revenue_by_segment,
    user_count_by_country,
)
from strata.operators.rows import filter_active_users, with_revenue_tier
from tests import fixtures as fx


def test_user_count_columns_and_values(spark):
    out = user_count_by_country(filter_active_users(fx.users(spark)))
    assert set(out.columns) == {"country", "user_count"}
    assert {r.country: r.user_count for r in out.collect()} == {"MA": 1, "BE": 2}


def test_null_country_is_a_group(spark):
    df = fx.users(spark, [("1", "A", "B", None, True), ("2", "C", "D", None, True), ("3", "E", "F", "US", True)])
    assert {r.country: r.user_count for r in user_count_by_country(df).collect()} == {None: 2, "US": 1}


def _active(spark):
    return fx.customers(spark, fx.NOOR_1, fx.INES_1, fx.TOMAS_1)


def test_revenue_by_country_columns(spark):
    out = revenue_by_country(_active(spark))
    assert set(out.columns) == {"country", "customer_count", "total_revenue", "avg_revenue"}


@pytest.mark.parametrize(("country", "count", "total", "avg"), [("BE", 2, 134_450.0, 67_225.0), ("MA", 1, 61_250.5, 61_250.5)])
def test_revenue_by_country_values(spark, country, count, total, avg):
    rows = {r.country: r for r in revenue_by_country(_active(spark)).collect()}
    assert (rows[country].customer_count, rows[country].total_revenue, rows[country].avg_revenue) == (count, total, avg)


def test_revenue_rounding_and_null_revenue(spark):
    a = fx.row("C1", ("A", "B"), ("US", "X"), "S", 10.005, fx.T1)
    b = fx.row("C2", ("A", "B"), ("US", "X"), "S", 0.001, fx.T1)
    c = fx.row("C3", ("A", "B"), ("FR", "X"), "S", None, fx.T1)
    rows = {r.country: r for r in revenue_by_country(fx.customers(spark, a, b, c)).collect()}
    assert rows["US"].total_revenue == 10.01 and rows["US"].avg_revenue == 5.0
    # a group with only null revenue counts its rows but has null sums
    assert (rows["FR"].customer_count, rows["FR"].total_revenue, rows["FR"].avg_revenue) == (1, None, None)


def test_revenue_by_segment(spark):
    out = revenue_by_segment(with_revenue_tier(_active(spark)))
    assert set(out.columns) == {"country", "revenue_tier", "customer_count", "total_revenue"}
    got = {(r.country, r.revenue_tier): (r.customer_count, r.total_revenue) for r in out.collect()}
    assert got == {("BE", "Platinum"): (1, 131_000.0), ("BE", "Bronze"): (1, 3_450.0), ("MA", "Gold"): (1, 61_250.5)}


def test_revenue_by_segment_counts_rows_not_customers(spark):
    df = with_revenue_tier(fx.customers(spark, fx.NOOR_1, fx.NOOR_2))
    (row,) = revenue_by_segment(df).collect()
    assert row.customer_count == 2 and row.total_revenue == 125_250.5


def test_aggregate_is_partial_then_final(spark):
    plan = fx.plan_text(count_by(fx.users(spark), ["country"], "n"), "simple")
    assert plan.count("HashAggregate") == 2 and "Exchange hashpartitioning(country" in plan


def test_exact_segment_sum_does_not_depend_on_order(spark):
    rows = [fx.row(f"C{i}", ("A", "B"), ("US", "X"), "S", v, fx.T1) for i, v in enumerate([0.1] * 10 + [0.2] * 10)]
    df = with_revenue_tier(fx.customers(spark, *rows))
    (r,) = revenue_by_segment(df, exact=True).collect()
    assert r.total_revenue == 3.0 and r.customer_count == 20
    (r,) = revenue_by_segment(df.repartition(7), exact=True).collect()
    assert r.total_revenue == 3.0


def test_revenue_levels_equal_the_two_aggregates(spark):
    from strata.operators.aggregates import revenue_levels, split_revenue_levels

    a = fx.row("C1", ("A", "B"), (None, "X"), "S", 120_000.0, fx.T1)
    b = fx.row("C2", ("A", "B"), (None, "X"), "S", None, fx.T1)
    df = with_revenue_tier(fx.customers(spark, fx.NOOR_1, fx.INES_1, fx.TOMAS_1, a, b))
    golds = split_revenue_levels(revenue_levels(df))
    key = lambda r: repr(r)
    assert sorted(golds["gold_revenue_by_country"].collect(), key=key) == sorted(revenue_by_country(df).collect(), key=key)
    assert sorted(golds["gold_revenue_by_segment"].collect(), key=key) == sorted(revenue_by_segment(df).collect(), key=key)
    plan = fx.plan_text(revenue_levels(df), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" in plan
