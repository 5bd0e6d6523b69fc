"""Layer jobs and stream-driven merges."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.rows import silver_customers
from strata.operators.scd import SchemaMismatchError, apply_scd_type2, empty_dimension
from strata.plans.layers import customer_dimension, customer_layers, run_customer_job, run_user_job, user_layers
from strata.schemas import CUSTOMER_SCHEMA
from strata.streaming import ingest_stream, read_stream, scd2_stream
from tests import fixtures as fx


def test_user_layers_lazy(spark):
    layers = user_layers(fx.users(spark))
    assert "full_name" in layers["silver_active_users"].columns
    assert layers["silver_active_users"].filter(~F.col("is_active")).count() == 0
    assert {r.country: r.user_count for r in layers["gold_user_count_by_country"].collect()} == {"MA": 1, "BE": 2}


def test_customer_layers_lazy(spark):
    bronze = fx.customers(spark, fx.NOOR_1, fx.NOOR_2, fx.UNNAMED_1, fx.INES_UNDATED, fx.AINO_AWAY_1)
    with pytest.raises(SchemaMismatchError):  # a source-shaped dimension cannot take silver rows
        customer_layers(bronze, fx.empty_state(spark))
    layers = customer_layers(bronze, empty_dimension(silver_customers(bronze)))
    silver = layers["silver_valid_customers"]
    assert {"full_name", "revenue_tier"} <= set(silver.columns) and silver.count() == 2
    assert layers["dim_customers_scd1"].count() == 1
    assert layers["dim_customers_scd2"].count() == 1


def test_user_job_writes_every_layer(spark, tmp_path):
    src = tmp_path / "users.csv"
    src.write_text("id,first_name,last_name,country,is_active\n1,A,B,US,true\n2,C,D,US,false\n3,E,F,IT,true\n")
    paths = run_user_job(spark, str(src), str(tmp_path / "wh"))
    gold = spark.read.parquet(paths["gold_user_count_by_country"])
    assert {r.country: r.user_count for r in gold.collect()} == {"US": 1, "IT": 1}


def test_customer_job_two_runs(spark, tmp_path):
    wh = str(tmp_path / "wh")
    src1, src2 = str(tmp_path / "s1"), str(tmp_path / "s2")
    fx.customers(spark, fx.NOOR_1, fx.PIET_1, fx.INES_UNDATED).write.parquet(src1)
    fx.customers(spark, fx.NOOR_3_MORE, fx.PIET_3, fx.MEI_3).write.parquet(src2)
    assert run_customer_job(spark, src1, wh, register=True).version == 1
    assert run_customer_job(spark, src2, wh).version == 2
    assert spark.catalog.getTable("gold_revenue_by_country").description
    silver = spark.read.parquet(os.path.join(wh, "silver_valid_customers"))
    dim = customer_dimension(spark, wh, silver.schema).read()
    assert dim.count() == 4 and dim.filter(F.col("is_current")).count() == 3
    gold = {r.country: r.customer_count for r in spark.read.parquet(os.path.join(wh, "gold_revenue_by_country")).collect()}
    assert gold == {"MA": 1, "BE": 1, "JP": 1}


def test_stream_merges_each_batch_once(spark, tmp_path):
    src, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    os.makedirs(src)
    store = customer_dimension(spark, str(tmp_path / "wh"), silver_customers(fx.customers(spark)).schema)
    stream = read_stream(spark, src, CUSTOMER_SCHEMA, max_files_per_trigger=1)

    fx.customers(spark, fx.NOOR_1, fx.PIET_1).coalesce(1).write.mode("append").parquet(src)
    q = scd2_stream(stream, store, checkpoint=ckpt)
    q.awaitTermination(120)
    fx.customers(spark, fx.NOOR_2).coalesce(1).write.mode("append").parquet(src)
    q = scd2_stream(stream, store, checkpoint=ckpt)
    q.awaitTermination(120)
    assert [c.batch_id for c in store.commits()] == [0, 1]
    s1 = silver_customers(fx.customers(spark, fx.NOOR_1, fx.PIET_1))
    s2 = silver_customers(fx.customers(spark, fx.NOOR_2))
    expected = apply_scd_type2(apply_scd_type2(empty_dimension(s1), s1), s2)
    assert sorted(store.read().collect()) == sorted(expected.collect())
    # a replay of batch 1 (e.g. after a crash before the checkpoint commit) changes nothing
    store.merge(fx.customers(spark, fx.NOOR_2), batch_id=1)
    assert len(store.commits()) == 2


def test_bronze_ingest_appends_new_files_only(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    os.makedirs(src)
    fx.customers(spark, fx.NOOR_1).write.mode("append").parquet(src)
    ingest_stream(read_stream(spark, src, CUSTOMER_SCHEMA), out, checkpoint=ckpt).awaitTermination(120)
    fx.customers(spark, fx.MEI_3).write.mode("append").parquet(src)
    ingest_stream(read_stream(spark, src, CUSTOMER_SCHEMA), out, checkpoint=ckpt).awaitTermination(120)
    assert sorted(r.customer_id for r in spark.read.parquet(out).collect()) == ["kt-204", "kt-900"]


def test_datasets_resolved_by_name(spark):
    from strata.plans.layers import compute_dataset

    fx.users(spark, fx.FIVE_USERS[:3]).createOrReplaceTempView("bronze_users")
    bronze = fx.customers(spark, fx.NOOR_1, fx.PIET_1, fx.UNNAMED_1)
    bronze.createOrReplaceTempView("bronze_customers")
    try:
        silver_users_df = compute_dataset(spark, "silver_active_users")
        assert "full_name" in silver_users_df.columns and silver_users_df.count() == 2
        silver_users_df.createOrReplaceTempView("silver_active_users")
        assert set(compute_dataset(spark, "gold_user_count_by_country").columns) == {"country", "user_count"}
        silver = compute_dataset(spark, "silver_valid_customers")
        assert {"full_name", "revenue_tier"} <= set(silver.columns) and silver.count() == 2
        silver.createOrReplaceTempView("silver_valid_customers")
        empty_dimension(silver).createOrReplaceTempView("dim_customers_scd2")
        assert compute_dataset(spark, "dim_customers_scd1").count() == 2
        assert compute_dataset(spark, "dim_customers_scd2").filter(F.col("is_current")).count() == 2
        assert set(compute_dataset(spark, "gold_revenue_by_segment").columns) == {
            "country", "revenue_tier", "customer_count", "total_revenue"
        }
        assert set(compute_dataset(spark, "gold_revenue_by_country").columns) == {
            "country", "customer_count", "total_revenue", "avg_revenue"
        }
        with pytest.raises(KeyError):
            compute_dataset(spark, "nope")
    finally:
        for v in ("bronze_users", "silver_active_users", "bronze_customers", "silver_valid_customers", "dim_customers_scd2"):
            spark.catalog.dropTempView(v)


def test_declarative_definitions_raise_outside_a_runner(spark, tmp_path):
    from pyspark.errors import PySparkRuntimeError

    from strata.plans.declarative import define_customer_datasets, define_user_datasets

    with pytest.raises(PySparkRuntimeError):
        define_user_datasets(str(tmp_path), spark)
    with pytest.raises(PySparkRuntimeError):
        define_customer_datasets(str(tmp_path), spark)


def test_merge_row_sets(spark):
    from strata.operators.scd import (
        closed_rows,
        historical_rows,
        inserted_rows,
        new_or_changed_rows,
        unchanged_current_rows,
    )

    state, snap = fx.existing_state(spark), fx.customers(spark, fx.NOOR_3_MORE, fx.MEI_3)
    assert sorted(r.customer_id for r in new_or_changed_rows(state, snap).collect()) == ["kt-204", "kt-900"]
    assert [(r.customer_id, r.effective_to) for r in closed_rows(state, snap).collect()] == [("kt-204", fx.T3)]
    assert sorted(r.customer_id for r in inserted_rows(state, snap).collect()) == ["kt-204", "kt-900"]
    assert [r.customer_id for r in unchanged_current_rows(state, snap).collect()] == ["kt-311"]
    assert [r.revenue_ytd for r in historical_rows(state).collect()] == [61_250.5]


def test_csv_bronze_stream(spark, tmp_path):
    from strata.schemas import USER_SCHEMA

    src, out, ckpt = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    src.mkdir()
    (src / "a.csv").write_text("id,first_name,last_name,country,is_active\n1,A,B,US,true\n2,C,D,IT,false\n")
    ingest_stream(read_stream(spark, str(src), USER_SCHEMA, fmt="csv"), out, checkpoint=ckpt).awaitTermination(120)
    bronze = spark.read.schema(USER_SCHEMA).parquet(out)
    assert sorted((r.id, r.is_active) for r in bronze.collect()) == [("1", True), ("2", False)]


def test_command_line(spark, tmp_path):
    from strata.__main__ import main

    src = tmp_path / "users.csv"
    src.write_text("id,first_name,last_name,country,is_active\n1,A,B,US,true\n")
    out = main(["user-job", "--source", str(src), "--warehouse", str(tmp_path / "wh")], spark)
    assert set(out["datasets"]) == {"bronze_users", "silver_active_users", "gold_user_count_by_country"}
    cust = str(tmp_path / "c")
    fx.customers(spark, fx.NOOR_1, fx.PIET_1).write.parquet(cust)
    args = ["customer-job", "--source", cust, "--warehouse", str(tmp_path / "wh2"), "--batch-id", "7", "--buckets", "4"]
    assert main(args, spark)["scd2_version"] == 1
    assert main(args, spark)["scd2_version"] == 1  # same batch again: skipped
    stream_src = str(tmp_path / "landing")
    fx.customers(spark, fx.NOOR_2).write.parquet(stream_src)
    stream = ["customer-stream", "--source", stream_src, "--checkpoint", str(tmp_path / "ck"), "--warehouse"]
    assert main([*stream, str(tmp_path / "wh3")], spark)["scd2_version"] == 1


def test_jobs_and_streams_refuse_each_others_warehouse(spark, tmp_path):
    from strata.plans.layers import run_customer_batch, run_customer_job

    src, wh = str(tmp_path / "c"), tmp_path / "wh"
    fx.customers(spark, fx.NOOR_1).write.parquet(src)
    run_customer_job(spark, src, str(wh / "full"))
    run_customer_batch(spark, src, str(wh / "batches"), 1)
    for job in (lambda: run_customer_batch(spark, src, str(wh / "full"), 2), lambda: run_customer_job(spark, src, str(wh / "batches"))):
        with pytest.raises(ValueError, match="another warehouse"):
            job()
    # data without a record of who keeps it
    fx.customers(spark, fx.NOOR_1).write.parquet(str(wh / "unmarked" / "bronze_customers"))
    with pytest.raises(ValueError, match="no .*_mode"):
        run_customer_job(spark, src, str(wh / "unmarked"))


def test_lineage_cut_writes_below_the_checkpoint_folder(spark):
    from strata.session import checkpoint_root, cut_lineage

    df = fx.customers(spark, fx.NOOR_1, fx.PIET_1)
    cut = cut_lineage(df)
    files = cut.inputFiles()
    assert files and all("strata-lineage" in f for f in files)
    assert checkpoint_root(spark).split(":")[-1].rstrip("/") in files[0]
    assert sorted(cut.collect()) == sorted(df.collect())


def test_deactivation_becomes_a_version_when_tracked(spark, tmp_path):
    from datetime import datetime

    gone = fx.row("kt-204", ("Noor", "Haddad"), ("MA", "Fes"), "wholesale", 61_250.5, datetime(2024, 2, 1), False)
    for track, expected in ((False, [(True, True)]), (True, [(False, True), (True, False)])):
        wh = str(tmp_path / f"wh{track}")
        s1, s2 = str(tmp_path / f"a{track}"), str(tmp_path / f"b{track}")
        fx.customers(spark, fx.NOOR_1).write.parquet(s1)
        fx.customers(spark, gone).write.parquet(s2)
        run_customer_job(spark, s1, wh, track_deactivation=track)
        run_customer_job(spark, s2, wh, track_deactivation=track)
        silver = spark.read.parquet(os.path.join(wh, "silver_valid_customers"))
        dim = customer_dimension(spark, wh, silver.schema).read()
        assert sorted((r.is_active, r.is_current) for r in dim.collect()) == expected


def test_late_rows_report(spark):
    from strata.operators.quality import late_rows

    late = fx.row("kt-204", ("Noor", "Haddad"), ("MA", "Fes"), "wholesale", 1.0, datetime_(2023, 6, 1))
    out = late_rows(fx.existing_state(spark), fx.customers(spark, late, fx.MEI_3, fx.PIET_3))
    assert [(r.customer_id, r.current_effective_from) for r in out.collect()] == [("kt-204", fx.T2)]


def datetime_(*a):
    from datetime import datetime

    return datetime(*a)


def test_command_line_incremental(spark, tmp_path):
    from strata.__main__ import main

    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    fx.customers(spark, fx.NOOR_1, fx.PIET_1).write.parquet(a)
    fx.customers(spark, fx.NOOR_2).write.parquet(b)
    wh = str(tmp_path / "wh")
    assert main(["customer-job", "--incremental", "--source", a, "--warehouse", wh, "--batch-id", "1"], spark)["scd2_version"] == 1
    assert main(["customer-job", "--incremental", "--source", b, "--warehouse", wh, "--batch-id", "2"], spark)["scd2_version"] == 2
    gold = {r.country: r.customer_count for r in spark.read.parquet(f"{wh}/gold_revenue_by_country").collect()}
    assert gold == {"MA": 2, "BE": 1}
    with pytest.raises(SystemExit):
        main(["customer-job", "--incremental", "--source", b, "--warehouse", wh], spark)


def test_customer_stream_runs_the_incremental_flow(spark, tmp_path):
    from strata.plans.layers import customer_scd1_table
    from strata.streaming import customer_stream

    src, wh, ck = str(tmp_path / "landing"), str(tmp_path / "wh"), str(tmp_path / "ck")
    fx.customers(spark, fx.NOOR_1, fx.PIET_1).coalesce(1).write.mode("append").parquet(src)
    customer_stream(read_stream(spark, src, CUSTOMER_SCHEMA), wh, checkpoint=ck).awaitTermination(120)
    fx.customers(spark, fx.NOOR_2, fx.MEI_3).coalesce(1).write.mode("append").parquet(src)
    customer_stream(read_stream(spark, src, CUSTOMER_SCHEMA), wh, checkpoint=ck).awaitTermination(120)
    silver_schema = silver_customers(fx.customers(spark)).schema
    assert [c.batch_id for c in customer_dimension(spark, wh, silver_schema).commits()] == [0, 1]
    scd1 = {r.customer_id: r.revenue_ytd for r in customer_scd1_table(spark, wh, silver_schema).read_version().collect()}
    assert scd1 == {"kt-204": 64_000.0, "kt-311": 14_300.0, "kt-900": 245_000.0}
    gold = {r.country: r.customer_count for r in spark.read.parquet(f"{wh}/gold_revenue_by_country").collect()}
    assert gold == {"MA": 2, "BE": 1, "JP": 1}


def test_declarative_definitions_register_the_layers(spark, tmp_path, monkeypatch):
    import types

    import strata.plans.declarative as D

    declared = {}

    def recorder(kind):
        def decorate(fn=None, *, name=None, comment=None, **_):
            declared[name] = (kind, comment, fn)

        return decorate

    fake = types.SimpleNamespace(table=recorder("table"), materialized_view=recorder("materialized_view"))
    monkeypatch.setattr(D, "_pipelines", lambda: fake)
    src = tmp_path / "users"
    src.mkdir()
    (src / "u.csv").write_text("id,first_name,last_name,country,is_active\n1,A,B,US,true\n")
    D.define_user_datasets(str(src), spark)
    D.define_customer_datasets(str(tmp_path), spark)
    assert {n: k for n, (k, _, _) in declared.items()} == {
        "bronze_users": "table",
        "silver_active_users": "materialized_view",
        "gold_user_count_by_country": "materialized_view",
        "bronze_customers": "table",
        "silver_valid_customers": "materialized_view",
        "gold_revenue_by_country": "materialized_view",
        "gold_revenue_by_segment": "materialized_view",
        "dim_customers_scd1": "materialized_view",
    }
    assert all(comment for _, comment, _ in declared.values())
    assert declared["bronze_users"][2]().isStreaming
    fx.users(spark).createOrReplaceTempView("bronze_users")
    try:
        silver = declared["silver_active_users"][2]()
        assert "full_name" in silver.columns and silver.count() == 3
    finally:
        spark.catalog.dropTempView("bronze_users")


def test_strict_user_job_rejects_a_renamed_header(spark, tmp_path):
    from strata.sources.files import SchemaDriftError

    src = tmp_path / "users.csv"
    src.write_text("uid,fn,ln,cc,active\n1,A,B,US,true\n")
    with pytest.raises(SchemaDriftError):
        run_user_job(spark, str(src), str(tmp_path / "wh"), strict=True)


def test_command_line_ignore_late(spark, tmp_path):
    from datetime import datetime

    from strata.__main__ import main

    newer, older = str(tmp_path / "newer"), str(tmp_path / "older")
    fx.customers(spark, fx.NOOR_2).write.parquet(newer)
    old = fx.row("kt-204", ("Noor", "Haddad"), ("MA", "Fes"), "wholesale", 1.0, datetime(2023, 1, 1))
    fx.customers(spark, old).write.parquet(older)
    for flags, expected in (([], 2), (["--ignore-late"], 1)):
        wh = str(tmp_path / f"wh{len(flags)}")
        main(["customer-job", "--incremental", "--source", newer, "--warehouse", wh, "--batch-id", "1"], spark)
        main(["customer-job", "--incremental", "--source", older, "--warehouse", wh, "--batch-id", "2", *flags], spark)
        silver_schema = silver_customers(fx.customers(spark)).schema
        assert customer_dimension(spark, wh, silver_schema).read().count() == expected
