"""Rejected CSV rows, and dimensions under a name of the catalog."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata.operators.scd import empty_dimension
from strata.plans.named import merge_and_publish, publish
from strata.plans.store import DimensionStore
from strata.schemas import USER_SCHEMA
from strata.sources.quarantine import REASON, RECORD, good_rows, read_csv_with_rejects, read_users_csv_with_rejects, rejected_rows
from tests import fixtures as fx

HEADER = "id,first_name,last_name,country,is_active\n"


def _csv(tmp_path, text):
    (tmp_path / "u.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "u.csv")


def test_rows_are_rejected_with_the_reason(spark, tmp_path):
    lines = ["1,A,B,MA,true", "2,A,B,MA", "3,A,B,MA,true,more", "4,A,B,MA,perhaps", "5,,,,", '6,"a, b",c,"d ""e""",FALSE', "7", '8,"","",,true']
    rows = read_users_csv_with_rejects(spark, _csv(tmp_path, HEADER + "\n".join(lines) + "\n"))
    assert good_rows(rows).schema == USER_SCHEMA
    good = {r.id: tuple(r)[1:] for r in good_rows(rows).collect()}
    assert good == {"1": ("A", "B", "MA", True), "5": (None, None, None, None), "6": ("a, b", "c", 'd "e"', False), "8": (None, None, None, True)} or \
        good["8"][:2] in {(None, None), ("", "")} and len(good) == 4
    assert sorted(map(tuple, rejected_rows(rows).collect())) == [
        ("2,A,B,MA", "too few fields"), ("3,A,B,MA,true,more", "too many fields"), ("4,A,B,MA,perhaps", "not readable: is_active"), ("7", "too few fields")]


def test_every_row_is_in_one_of_both_whatever_is_selected(spark, tmp_path):
    rows = read_users_csv_with_rejects(spark, _csv(tmp_path, HEADER + "1,A,B,MA,true\n2,A,B,MA,perhaps\n3,A\n"))
    assert [r.id for r in good_rows(rows).select("id").collect()] == ["1"]  # the damage is in other columns
    assert rows.count() == 3 and rejected_rows(rows).count() == 2 and rows.where(f"{RECORD} is null").count() == 1


def test_quoted_line_breaks(spark, tmp_path):
    path = _csv(tmp_path, HEADER + '1,"A\nx",B,MA,true\n2,"A\ny",B,MA\n3,A,B,MA,false\n')
    rows = read_users_csv_with_rejects(spark, path, multi_line=True)
    assert {r.id: r.first_name for r in good_rows(rows).collect()} == {"1": "A\nx", "3": "A"}
    assert [r[REASON] for r in rejected_rows(rows).collect()] == ["too few fields"]


def test_several_unreadable_columns_and_an_empty_file(spark, tmp_path):
    schema = StructType([StructField("n", IntegerType()), StructField("x", DoubleType()), StructField("s", StringType())])
    rows = read_csv_with_rejects(spark, _csv(tmp_path, "n,x,s\none,two,three\n1,2.5,z\n1.5,3,z\n"), schema)
    assert sorted(map(tuple, rejected_rows(rows).collect())) == [("1.5,3,z", "not readable: n"), ("one,two,three", "not readable: n, x")]
    assert [tuple(r) for r in good_rows(rows).collect()] == [(1, 2.5, "z")]
    assert read_csv_with_rejects(spark, _csv(tmp_path, "n,x,s\n"), schema).collect() == []


@pytest.mark.parametrize("buckets", [None, 4])
def test_the_name_follows_the_log(spark, tmp_path, buckets):
    snaps = [[fx.NOOR_1, fx.PIET_1, fx.UNNAMED_1], [fx.NOOR_2], [fx.NOOR_3_MORE, fx.PIET_3_MORE, fx.MEI_3]]
    schema = empty_dimension(fx.customers(spark)).schema
    store, name = DimensionStore(spark, str(tmp_path / "dim"), schema, buckets=buckets), f"dim_{uuid.uuid4().hex[:8]}"
    with pytest.raises(ValueError):
        publish(store, name)
    for batch, snap in enumerate(snaps):
        merge_and_publish(store, fx.customers(spark, *snap), name, "Customers' history", batch_id=batch)
        assert spark.table(name).columns == schema.fieldNames()
        assert sorted(map(repr, spark.table(name).collect())) == sorted(map(repr, store.read().collect()))
    # rows of an attempt that was never committed are not seen
    store.read().limit(1).selectExpr("*", "true AS has_key").write.partitionBy("is_current", "has_key").parquet(f"{store.data_path}/attempt=00000009-aaaaaaaaaaaa")
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == store.read().count()
    assert spark.catalog.getTable(name).description == "Customers' history"
    store.compact()
    publish(store, name, "compacted")
    assert sorted(map(repr, spark.table(name).collect())) == sorted(map(repr, store.read().collect()))
