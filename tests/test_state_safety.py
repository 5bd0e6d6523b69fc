"""State that must not be lost: null flags, small and special amounts, warehouses kept two ways, double commits."""

from __future__ import annotations

import math
from datetime import datetime

import pytest

from strata.operators.scd import scd2_merge
from strata.plans.layers import gold_partials, golds_from_partials, run_customer_batch, run_customer_job
from strata.plans.store import DimensionStore
from strata.schemas import CUSTOMER_SCHEMA, SCD2_SCHEMA

DAY = datetime(2021, 5, 9)


def _snapshot_row(key: str, amount: float = 10.0):
    values = {"customer_id": key, "revenue_ytd": amount, "is_active": True, "updated_at": DAY, "country": "PT"}
    return tuple(values.get(name) for name in CUSTOMER_SCHEMA.fieldNames())


def _dimension_row(key: str, flag):
    values = {"customer_id": key, "is_active": True, "updated_at": DAY, "effective_from": DAY, "is_current": flag, "hash_version": 1}
    return tuple(values.get(name) for name in SCD2_SCHEMA.fieldNames())


def test_rows_with_a_null_flag_survive_merge_and_store(spark, scratch):
    state = spark.createDataFrame([_dimension_row("k1", True), _dimension_row("k2", None), _dimension_row("k3", False), _dimension_row("k4", True)], SCD2_SCHEMA)
    nothing = spark.createDataFrame([], CUSTOMER_SCHEMA)
    assert scd2_merge(state, nothing).count() == 4
    store = DimensionStore(spark, scratch + "/dim", SCD2_SCHEMA)
    store.write_full(state)
    assert store.read().count() == 4
    store.compact()
    assert {r["customer_id"] for r in store.read().collect()} == {"k1", "k2", "k3", "k4"}


def test_incremental_golds_keep_amounts(spark):
    rows = [("PT", "low", 0.004)] * 1000 + [("ES", "low", float("nan")), ("IT", "high", 1e17)]
    silver = spark.createDataFrame(rows, "country string, revenue_tier string, revenue_ytd double")
    gold = {r["country"]: r["total_revenue"] for r in golds_from_partials(gold_partials(silver))["gold_revenue_by_segment"].collect()}
    assert gold["PT"] == pytest.approx(4.0) and math.isnan(gold["ES"]) and gold["IT"] == 1e17


def test_a_warehouse_is_kept_one_way(spark, scratch):
    source = scratch + "/landing"
    spark.createDataFrame([_snapshot_row("k1"), _snapshot_row("k2")], CUSTOMER_SCHEMA).write.parquet(source)
    run_customer_job(spark, source, scratch + "/full")
    with pytest.raises(ValueError, match="full refresh"):
        run_customer_batch(spark, source, scratch + "/full", batch_id=1)
    run_customer_batch(spark, source, scratch + "/batches", batch_id=1)
    with pytest.raises(ValueError, match="incremental"):
        run_customer_job(spark, source, scratch + "/batches")


def test_a_version_committed_twice_is_an_error(spark, scratch):
    store = DimensionStore(spark, scratch + "/dim", SCD2_SCHEMA)
    commit = store.write_full(spark.createDataFrame([_dimension_row("k1", True)], SCD2_SCHEMA))
    store._append_log(commit)
    with pytest.raises(RuntimeError, match="twice"):
        store.read()
