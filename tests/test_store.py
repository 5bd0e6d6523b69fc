"""Versioned SCD2 storage."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strata.operators.scd import apply_scd_type2
from strata.plans.store import DimensionStore
from strata.schemas import SCD2_SCHEMA
from tests import fixtures as fx


def _store(spark, root, buckets=None):
    return DimensionStore(spark, root, SCD2_SCHEMA, buckets=buckets)


@pytest.mark.parametrize("buckets", [None, 4])
def test_versions_match_in_memory_merges(spark, scratch, buckets):
    store = _store(spark, f"{scratch}/dim", buckets)
    s1 = fx.customers(spark, fx.NOOR_1, fx.PIET_1)
    s2 = fx.customers(spark, fx.NOOR_2, fx.PIET_3, fx.MEI_3)
    s3 = fx.customers(spark, fx.NOOR_3_MORE, fx.PIET_3_MORE)
    assert store.merge(s1).version == 1
    assert store.merge(s2).version == 2
    assert store.merge(s3).version == 3
    expected = apply_scd_type2(apply_scd_type2(apply_scd_type2(fx.empty_state(spark), s1), s2), s3)
    assert sorted(store.read().collect()) == sorted(expected.collect())
    v2 = apply_scd_type2(apply_scd_type2(fx.empty_state(spark), s1), s2)
    assert sorted(store.read(2).collect()) == sorted(v2.collect())
    assert store.read_current().count() == 3


def test_history_is_not_rewritten(spark, scratch):
    store = _store(spark, f"{scratch}/dim")
    store.merge(fx.customers(spark, fx.NOOR_1, fx.PIET_1))
    store.merge(fx.customers(spark, fx.NOOR_2))
    v3 = store.merge(fx.customers(spark, fx.NOOR_3))
    closed_v3 = spark.read.parquet(f"{v3.path}/is_current=false/has_key=true")
    assert [r.revenue_ytd for r in closed_v3.collect()] == [64_000.0]


def test_reads_prune_partitions(spark, scratch):
    store = _store(spark, f"{scratch}/dim")
    store.merge(fx.customers(spark, fx.NOOR_1))
    store.merge(fx.customers(spark, fx.NOOR_2))
    plan = fx.plan_text(store.read_current())
    pruned = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert "attempt" in pruned and "is_current" in pruned


def test_replayed_batch_is_skipped(spark, scratch):
    store = _store(spark, f"{scratch}/dim")
    store.merge(fx.customers(spark, fx.NOOR_1), batch_id=0)
    store.merge(fx.customers(spark, fx.NOOR_2), batch_id=1)
    again = store.merge(fx.customers(spark, fx.NOOR_2), batch_id=1)
    assert again.version == 2 and len(store.commits()) == 2


def test_uncommitted_version_is_ignored_and_overwritten(spark, scratch):
    store = _store(spark, f"{scratch}/dim")
    store.merge(fx.customers(spark, fx.NOOR_1))
    # an interrupted attempt: data written for version 2, no log row
    junk = store.read().withColumn("revenue_ytd", F.lit(-1.0))
    stale = store._write(junk, 2)
    assert [r.revenue_ytd for r in store.read().collect()] == [61_250.5]
    v2 = store.merge(fx.customers(spark, fx.NOOR_2))
    assert v2.version == 2 and v2.path != stale
    assert sorted(r.revenue_ytd for r in store.read().collect()) == [61_250.5, 64_000.0]


def test_full_write_starts_a_new_base(spark, scratch):
    store = _store(spark, f"{scratch}/dim")
    store.merge(fx.customers(spark, fx.NOOR_1))
    store.merge(fx.customers(spark, fx.NOOR_2))
    whole = store.read()
    commit = store.write_full(spark.createDataFrame(whole.collect(), SCD2_SCHEMA))
    assert commit.base == commit.version == 3
    assert sorted(store.read().collect()) == sorted(whole.collect())


def test_bucketed_current_slice_is_not_shuffled(spark, scratch):
    store = _store(spark, f"{scratch}/dim", buckets=4)
    store.merge(fx.customers(spark, fx.NOOR_1, fx.PIET_1))
    store.merge(fx.customers(spark, fx.NOOR_2))
    from strata.operators.scd import scd2_changes
    from strata.plans.store import _session_conf

    keyed, keyless = store._current_parts(store.latest())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with _session_conf(spark, "spark.sql.shuffle.partitions", "4"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            changes = scd2_changes(keyed, fx.customers(spark, fx.NOOR_3), keyless_current=keyless)
            plan = fx.plan_text(changes, "simple")
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # only the incoming snapshot is shuffled; the current slice is read bucketed
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SelectedBucketsCount: 4 out of 4" in plan
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # restored


def test_keyless_rows_stay_out_of_the_buckets(spark, scratch):
    store = _store(spark, f"{scratch}/dim", buckets=4)
    store.merge(fx.customers(spark, fx.UNNAMED_1, fx.NOOR_1))
    store.merge(fx.customers(spark, fx.UNNAMED_1, fx.NOOR_2))
    current = store.read_current()
    assert sorted((r.customer_id or "") for r in current.collect()) == ["", "", "kt-204"]
    plan = fx.plan_text(current, "simple")
    assert "strata_bucketed_" in plan  # keyed rows: the bucketed table
    assert "has_key" in plan  # keyless rows: their own partition, plain scan
    assert store.read().count() == 4


@pytest.mark.parametrize("buckets", [None, 4])
def test_compact_keeps_the_dimension(spark, scratch, buckets):
    store = _store(spark, f"{scratch}/dim", buckets)
    for snap in ([fx.NOOR_1, fx.PIET_1, fx.UNNAMED_1], [fx.NOOR_2], [fx.NOOR_3, fx.MEI_3]):
        store.merge(fx.customers(spark, *snap))
    before = sorted(store.read().collect(), key=repr)
    c = store.compact()
    assert (c.version, c.base, c.kind) == (4, 4, "full")
    assert sorted(store.read().collect(), key=repr) == before
    assert sorted(store.read(3).collect(), key=repr) == before
    store.merge(fx.customers(spark, fx.NOOR_3_MORE))
    assert store.read().count() == len(before) + 1


@pytest.mark.parametrize("buckets", [None, 4])
def test_schema_evolution(spark, scratch, buckets):
    from pyspark.sql.types import StringType, StructField, StructType

    from strata.operators.scd import SchemaMismatchError

    store = _store(spark, f"{scratch}/dim", buckets)
    store.merge(fx.customers(spark, fx.NOOR_1, fx.PIET_1))
    richer = fx.customers(spark, fx.NOOR_2).withColumn("tier_code", F.lit("A"))
    with pytest.raises(SchemaMismatchError):
        store.merge(richer)
    evolved = StructType(list(SCD2_SCHEMA.fields[:10]) + [StructField("tier_code", StringType())] + list(SCD2_SCHEMA.fields[10:]))
    store2 = DimensionStore(spark, f"{scratch}/dim", evolved, buckets=buckets)
    store2.merge(richer, allow_missing_columns=True)
    rows = {(r.customer_id, r.revenue_ytd): r.tier_code for r in store2.read().collect()}
    assert rows == {("kt-204", 61_250.5): None, ("kt-204", 64_000.0): "A", ("kt-311", 14_300.0): None}


def test_store_late_rows_and_report(spark, scratch):
    from datetime import datetime

    store = _store(spark, f"{scratch}/dim", buckets=4)
    store.merge(fx.customers(spark, fx.NOOR_2, fx.PIET_1))
    late = fx.row("kt-204", ("Noor", "Haddad"), ("MA", "Fes"), "wholesale", 1.0, datetime(2023, 1, 1))
    assert [r.customer_id for r in store.late_rows(fx.customers(spark, late, fx.MEI_3)).collect()] == ["kt-204"]
    (r,) = store.report().collect()
    assert (r.rows, r.current_rows, r.duplicate_current_keys) == (2, 2, 0)


def test_command_line_report(spark, tmp_path):
    from strata.__main__ import main

    src = str(tmp_path / "c")
    fx.customers(spark, fx.NOOR_1, fx.PIET_1).write.parquet(src)
    wh = str(tmp_path / "wh")
    main(["customer-job", "--source", src, "--warehouse", wh], spark)
    out = main(["report", "--warehouse", wh], spark)
    assert out["version"] == 1 and out["rows"] == 2 and out["current_rows"] == 2
