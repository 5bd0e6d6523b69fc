"""Quality reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from strata.operators.quality import (
    dimension_report,
    duplicate_current,
    duplicate_keys,
    interval_violations,
    key_uniqueness,
    null_current_flags,
    null_keys,
    open_history,
)
from strata.operators.scd import apply_scd_type2
from tests import fixtures as fx


def _broken_state(spark):
    """Two current rows for kt-204, a null flag, a late interval, a stale version, a null key."""
    rows = fx.existing_state(spark).collect()
    extra = [
        fx.NOOR_3 + (fx.T3, None, True, 1),
        fx.TOMAS_1 + (fx.T1, None, None, 1),
        fx.AINO_AWAY_1 + (fx.T3, fx.T1, False, 1),
        fx.MEI_3 + (fx.T3, None, True, None),
        fx.UNNAMED_1 + (fx.T1, None, True, 1),
    ]
    return spark.createDataFrame([tuple(r) for r in rows] + extra, fx.existing_state(spark).schema)


def test_duplicate_current(spark):
    assert [(r.customer_id, r.cnt) for r in duplicate_current(_broken_state(spark)).collect()] == [("kt-204", 2)]
    assert duplicate_current(fx.existing_state(spark)).count() == 0


def test_duplicate_keys_include_null_group(spark):
    df = fx.customers(spark, fx.UNNAMED_1, fx.UNNAMED_1, fx.NOOR_1)
    assert [(r.customer_id, r.cnt) for r in duplicate_keys(df).collect()] == [(None, 2)]


def test_key_uniqueness_counts_null_as_a_value(spark):
    (r,) = key_uniqueness(fx.customers(spark, fx.UNNAMED_1, fx.NOOR_1)).collect()
    assert (r.rows, r.distinct_keys, r.is_unique) == (2, 2, True)
    (r,) = key_uniqueness(fx.customers(spark, fx.NOOR_2, fx.NOOR_1)).collect()
    assert (r.rows, r.distinct_keys, r.is_unique) == (2, 1, False)


def test_row_level_checks(spark):
    state = _broken_state(spark)
    assert [r.customer_id for r in null_keys(state).collect()] == [None]
    assert [r.customer_id for r in interval_violations(state).collect()] == ["kt-518"]
    assert [r.customer_id for r in null_current_flags(state).collect()] == ["kt-455"]
    assert open_history(state).count() == 0


def test_dimension_report(spark):
    (r,) = dimension_report(_broken_state(spark)).collect()
    assert r.asDict() == {
        "rows": 8,
        "current_rows": 5,
        "history_rows": 2,
        "null_is_current_rows": 1,
        "interval_violations": 1,
        "open_history_rows": 0,
        "stale_hash_rows": 1,
        "null_key_rows": 1,
        "duplicate_current_keys": 1,
    }


def test_report_on_a_merge_result_is_clean(spark):
    out = apply_scd_type2(fx.existing_state(spark), fx.customers(spark, fx.NOOR_3_MORE, fx.MEI_3))
    (r,) = dimension_report(out).collect()
    assert (r.duplicate_current_keys, r.interval_violations, r.open_history_rows, r.null_key_rows) == (0, 0, 0, 0)
    late = fx.row("kt-311", ("Piet", "Visser"), ("BE", "Brugge"), "hobby", 1.0, datetime(2023, 1, 1))
    (r,) = dimension_report(apply_scd_type2(out, fx.customers(spark, late))).collect()
    assert r.interval_violations == 1
    assert out.filter(F.col("is_current")).count() == 3
