"""The drop-in names behave like the operators they map to."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import compat
from tests import fixtures as fx


def test_names_map_onto_operators(spark):
    df = fx.customers(spark, fx.NOOR_1, fx.PIET_AWAY_1, fx.INES_1, fx.TOMAS_1, fx.AINO_AWAY_1)
    silver = compat.enrich_with_revenue_tier(compat.enrich_with_full_name(compat.filter_active_customers(df)))
    assert silver.count() == 3
    assert compat.aggregate_revenue_by_segment(silver).count() == 3
    assert compat.apply_scd_type1(fx.customers(spark, fx.NOOR_1, fx.NOOR_2)).count() == 1
    out = compat.apply_scd_type2(fx.existing_state(spark), fx.customers(spark, fx.NOOR_3_MORE))
    assert compat.get_current_active(out).count() == 2 and compat.get_historical_rows(out).count() == 2
    assert compat.SCD2_TRACKED_COLUMNS[0] == "first_name" and compat.HASH_VERSION == 1


def test_change_hash_on_a_join_side(spark):
    a = fx.customers(spark, fx.NOOR_1).alias("new")
    b = fx.customers(spark, fx.NOOR_2).alias("old")
    joined = a.join(b, F.col("new.customer_id") == F.col("old.customer_id"))
    (r,) = joined.select(
        (compat.build_change_hash("new", ["country"]) == compat.build_change_hash("old", ["country"])).alias("same"),
        (compat.build_change_hash("new", ["revenue_ytd"]) == compat.build_change_hash("old", ["revenue_ytd"])).alias("diff"),
    ).collect()
    assert r.same is True and r.diff is False


def test_merge_steps_by_their_names(spark):
    state, incoming = fx.existing_state(spark), fx.customers(spark, fx.NOOR_3_MORE, fx.MEI_3)
    current = compat.get_current_active(state)
    changed = compat.detect_changed_or_new(compat.join_incoming_with_current(incoming, current), compat.SCD2_TRACKED_COLUMNS)
    assert changed.filter(F.col("old.customer_id").isNull()).count() == 1
    out = compat.get_historical_rows(state)
    for part in (
        compat.build_closed_rows(changed, state),
        compat.build_inserted_rows(changed, incoming),
        compat.get_unchanged_current_rows(current, changed),
    ):
        out = out.unionByName(part)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, compat.apply_scd_type2(state, incoming).collect()))


def test_compute_by_name(spark):
    fx.users(spark).createOrReplaceTempView("bronze_users")
    try:
        assert compat.compute_silver_active_users(spark).count() == 3
    finally:
        spark.catalog.dropTempView("bronze_users")
