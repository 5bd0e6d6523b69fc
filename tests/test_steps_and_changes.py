"""Merge steps on one joined frame, keyless rows, golds by signed changes, latest rows by aggregation, stable sums."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.constants import TRACKED_COLUMNS
from strata.functions import stable
from strata.operators.deltas import apply_partials, signed_partials
from strata.operators.dedupe import latest_by_aggregate, latest_per_key
from strata.operators.rows import silver_customers, with_revenue_tier
from strata.operators.scd import apply_scd_type2, current_rows, empty_dimension, history_rows, scd2_changes, scd2_merge_keyless
from strata.operators.steps import (
    build_closed_rows,
    build_inserted_rows,
    detect_changed_or_new,
    get_unchanged_current_rows,
    join_incoming_with_current,
)
from strata.plans.layers import golds_from_partials
from tests import fixtures as fx


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- steps --------------------------------------------------------------------


@pytest.mark.parametrize("snap", [(), (fx.NOOR_3_MORE, fx.MEI_3), (fx.PIET_3, fx.UNNAMED_1), (fx.NOOR_3, fx.PIET_3_MORE)])
def test_the_steps_together_are_the_merge(spark, snap):
    state, incoming = fx.existing_state(spark), latest_per_key(fx.customers(spark, *snap), "customer_id", "updated_at")
    current = current_rows(state)
    changed = detect_changed_or_new(join_incoming_with_current(incoming, current), TRACKED_COLUMNS)
    parts = [build_closed_rows(changed), build_inserted_rows(changed), get_unchanged_current_rows(current, changed), history_rows(state)]
    whole = parts[0].select(*state.columns)
    for part in parts[1:]:
        whole = whole.unionByName(part)
    assert _got(whole.select(*state.columns)) == _got(apply_scd_type2(state, incoming))


def test_the_joined_frame_can_be_written_and_filtered(spark, scratch):
    joined = join_incoming_with_current(fx.customers(spark, fx.NOOR_3, fx.MEI_3), current_rows(fx.existing_state(spark)))
    joined.write.parquet(f"{scratch}/joined")
    again = detect_changed_or_new(spark.read.parquet(f"{scratch}/joined"), TRACKED_COLUMNS)
    assert sorted(r.customer_id for r in again.where("old.customer_id is null").select("new.*").collect()) == ["kt-900"]
    assert [(r.revenue_ytd, r.effective_to) for r in build_closed_rows(again).collect()] == [(64_000.0, fx.T3)]


# ---- keyless rows ---------------------------------------------------------------


def _keyless(df):
    return Counter((r.last_name, r.revenue_ytd, r.is_current) for r in df.where("customer_id is null").collect())


def test_the_same_keyless_rows_twice_add_nothing(spark):
    other = fx.row(None, ("Lu", "Roe"), ("FI", "Oulu"), "hobby", 5.0, None)
    snap = fx.customers(spark, fx.UNNAMED_1, fx.UNNAMED_1, other, fx.NOOR_1)
    once = scd2_merge_keyless(empty_dimension(snap), snap)
    assert _keyless(once) == {("Doe", 14_300.0, True): 2, ("Roe", 5.0, True): 1}
    assert _got(scd2_merge_keyless(once, snap)) == _got(once)
    more = scd2_merge_keyless(once, fx.customers(spark, *[fx.UNNAMED_1] * 3, fx.NOOR_2))
    assert _keyless(more) == {("Doe", 14_300.0, True): 3, ("Roe", 5.0, True): 1}
    assert more.where("customer_id = 'kt-204'").count() == 2


def test_keyless_rows_that_are_gone_can_be_closed(spark):
    at = datetime(2031, 1, 1)
    snap = fx.customers(spark, fx.UNNAMED_1, fx.UNNAMED_1, fx.NOOR_1)
    state = scd2_merge_keyless(empty_dimension(snap), snap)
    out = scd2_merge_keyless(state, fx.customers(spark, fx.UNNAMED_1, fx.NOOR_1), absent="close", close_absent_at=at)
    assert _keyless(out) == {("Doe", 14_300.0, True): 1, ("Doe", 14_300.0, False): 1}
    assert {r.effective_to for r in out.where("not is_current").collect()} == {at}


# ---- golds by changes -------------------------------------------------------------


def test_golds_by_changes_equal_the_golds_of_the_current_rows(spark):
    rng = random.Random(4)
    dimension = state = None
    for step in range(5):
        rows = [
            fx.row(f"k{k}", ("A", "B"), (rng.choice(["MA", "BE", None]), "x"), "s", rng.choice([None, 0.1, 0.2, 70_000.07, 120_000.5, 1 / 3]),
                   fx.T1 + timedelta(days=30 * step + k % 5))
            for k in rng.sample(range(25), 15)
        ]
        snap = silver_customers(fx.customers(spark, *rows))
        dimension = empty_dimension(snap) if dimension is None else dimension
        changes = scd2_changes(dimension, snap)
        changes = spark.createDataFrame(changes.collect(), changes.schema)
        state = apply_partials(state, signed_partials(changes))
        state = spark.createDataFrame(state.collect(), state.schema)
        dimension = changes.drop("scd2_change")
        got = {(r.country, r.revenue_tier): (r.customer_count, r.total_revenue) for r in golds_from_partials(state)["gold_revenue_by_segment"].collect()}
        want: dict = {}
        for r in current_rows(dimension).collect():
            n, total = want.get((r.country, r.revenue_tier), (0, None))
            want[r.country, r.revenue_tier] = (n + 1, total if r.revenue_ytd is None else (total or 0.0) + r.revenue_ytd)
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0] and got[k][1] == (None if want[k][1] is None else pytest.approx(want[k][1], abs=1e-6))
    assert state.count() == len(want)


# ---- latest rows by aggregation -----------------------------------------------------


def test_latest_by_aggregate_equals_the_window(spark):
    rng = random.Random(9)
    at = [None, *[datetime(2030, 1, d) for d in range(1, 6)]]
    rows = [(rng.choice(["a", "b", "c", "d", None]), rng.choice([1, 2]), rng.choice(at), rng.choice("xyz"), [rng.randrange(2)]) for _ in range(300)]
    df = spark.createDataFrame(rows + [("only", 1, None, "x", [1])], "k string, j int, ts timestamp, v string, list array<int>").repartition(6)
    for key in ("k", ["k", "j"]):
        assert _got(latest_by_aggregate(df, key, "ts")) == _got(latest_per_key(df, key, "ts"))
    assert latest_by_aggregate(df.limit(0), "k", "ts").collect() == []
    plan = fx.plan_text(latest_by_aggregate(df, "k", "ts"), "simple")
    assert "Window" not in plan


def test_only_tied_rows_are_digested(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "p"), ("b", 5, "q"), ("b", 4, "r")], "k string, n int, v string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    import strata.operators.dedupe as dedupe

    plain, dedupe.row_digest = dedupe.row_digest, lambda columns: counted(F.col("v"))
    try:
        rows = latest_by_aggregate(df, "k", "n").collect()
    finally:
        dedupe.row_digest = plain
    assert sorted(r.v for r in rows) == ["q", "y"] and seen.value == 2


# ---- stable sums -----------------------------------------------------------------------


def _bits(x):
    return None if x is None else "nan" if math.isnan(x) else x.hex()


@pytest.mark.parametrize("values", [
    [0.1] * 10 + [0.2, -0.3, 1e-12, 123456789.01], [1e16, 1.0, -1e16, 0.5], [3.3e18, 2.5e25, -7.0, 0.25], [None, None], [], [-0.7] * 7,
    [float("nan"), 1.0], [float("inf"), 2.0], [float("inf"), float("-inf")], [-1e300, 5.0], [1e-18, 2e-18], [9.9e18] * 50])
def test_stable_sums_are_the_exact_sum_in_any_partitioning(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = set()
    for parts in (1, 3, 7):
        found.add(_bits(df.repartition(parts).agg(*stable.sums("v")).select(stable.total().alias("t")).first().t))
    halves = [df.where(F.pmod(F.xxhash64("v"), F.lit(3)) == k).agg(*stable.sums("v")) for k in range(3)]
    state = halves[0].unionByName(halves[1]).unionByName(halves[2]).agg(*stable.merged())
    found.add(_bits(state.select(stable.total().alias("t")).first().t))
    there = [v for v in values if v is not None]
    if not there:
        want = None
    elif any(math.isnan(v) for v in there) or {float("inf"), float("-inf")} <= set(there):
        want = float("nan")
    elif any(abs(v) >= 1e37 for v in there):
        want = math.copysign(float("inf"), next(v for v in there if abs(v) >= 1e37))
    else:
        want = float(sum(Fraction(repr(v)) for v in there))
    assert found == {_bits(want)}


def test_stable_sums_per_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), round(rng.uniform(-1e6, 1e6), 2)) for _ in range(3000)]
    df = with_revenue_tier(spark.createDataFrame(rows, "country string, revenue_ytd double"))
    got = {r.country: r.t for r in df.groupBy("country").agg(*stable.sums("revenue_ytd")).select("country", stable.total().alias("t")).collect()}
    assert got == {g: float(sum(Fraction(repr(v)) for h, v in rows if h == g)) for g in "ab"}
