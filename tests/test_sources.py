"""Explicit-schema readers, permissive and strict."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata.schemas import CUSTOMER_SCHEMA, USER_SCHEMA
from strata.sources.files import SchemaDriftError, read_customers_parquet, read_users_csv
from tests import fixtures as fx

HEADER = "id,first_name,last_name,country,is_active\n"


def _csv(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return str(path)


def test_csv_schema_and_rows(spark, tmp_path):
    path = _csv(tmp_path / "u.csv", HEADER + "u-03,Noor,Haddad,MA,true\nu-08,Piet,Visser,NL,false\n")
    df = read_users_csv(spark, path)
    assert df.schema == USER_SCHEMA and df.count() == 2


def test_csv_header_only(spark, tmp_path):
    df = read_users_csv(spark, _csv(tmp_path / "u.csv", HEADER))
    assert df.count() == 0 and df.schema == USER_SCHEMA


def test_dirty_csv_is_read_permissively(spark, tmp_path):
    text = HEADER + '2,C,D,UK,yes\n3,E,F\n4,,"",IT,TRUE\n5,a,b,c,true,extra\n'
    rows = {r.id: r for r in read_users_csv(spark, _csv(tmp_path / "u.csv", text)).collect()}
    assert rows["2"].is_active is None
    assert rows["3"].country is None and rows["3"].is_active is None
    assert rows["4"].first_name is None and rows["4"].last_name is None and rows["4"].is_active is True
    assert rows["5"].country == "c" and rows["5"].is_active is True


def test_renamed_header_is_read_by_position_unless_strict(spark, tmp_path):
    path = _csv(tmp_path / "u.csv", "uid,fn,ln,cc,active\nU1,A,B,US,true\n")
    assert read_users_csv(spark, path).collect()[0].id == "U1"
    with pytest.raises(SchemaDriftError):
        read_users_csv(spark, path, strict=True)


def test_strict_csv_fails_on_bad_value(spark, tmp_path):
    path = _csv(tmp_path / "u.csv", HEADER + "U1,A,B,US,yes\n")
    df = read_users_csv(spark, path, strict=True)
    with pytest.raises(Exception):
        df.collect()


def _customer_parquet(spark, path):
    fx.customers(spark, fx.NOOR_1, fx.PIET_1).write.parquet(path)
    return path


def test_parquet_schema_and_rows(spark, scratch):
    df = read_customers_parquet(spark, _customer_parquet(spark, f"{scratch}/c"))
    assert df.schema == CUSTOMER_SCHEMA and df.count() == 2


def test_parquet_missing_column_is_null_unless_strict(spark, scratch):
    path = f"{scratch}/c"
    fx.customers(spark, fx.NOOR_1).drop("city").write.parquet(path)
    assert read_customers_parquet(spark, path).collect()[0].city is None
    with pytest.raises(SchemaDriftError, match="missing city"):
        read_customers_parquet(spark, path, strict=True)


def test_parquet_type_drift_detected_before_reading(spark, scratch):
    path = f"{scratch}/c"
    schema = StructType([StructField(f.name, StringType() if f.name == "revenue_ytd" else f.dataType) for f in CUSTOMER_SCHEMA])
    row = list(fx.NOOR_1)
    row[7] = "61250.5"
    spark.createDataFrame([tuple(row)], schema).write.parquet(path)
    with pytest.raises(SchemaDriftError, match="revenue_ytd"):
        read_customers_parquet(spark, path, strict=True)
    assert CUSTOMER_SCHEMA["revenue_ytd"].dataType == DoubleType()


def test_parquet_reader_prunes_to_declared_columns(spark, scratch):
    path = f"{scratch}/c"
    fx.customers(spark, fx.NOOR_1).withColumn("unused", fx_lit()).write.parquet(path)
    plan = fx.plan_text(read_customers_parquet(spark, path).select("country"))
    assert "ReadSchema: struct<country:string>" in plan


def fx_lit():
    from pyspark.sql import functions as F

    return F.lit(datetime(2020, 1, 1))


def test_strict_parquet_checks_every_file(spark, scratch):
    path = f"{scratch}/c"
    fx.customers(spark, fx.NOOR_1).write.mode("append").parquet(path)
    fx.customers(spark, fx.PIET_1).drop("email").write.mode("append").parquet(path)
    # the merged schema still has every column: accepted, the missing values read as null
    assert read_customers_parquet(spark, path, strict=True).count() == 2
    schema = StructType([StructField(f.name, StringType() if f.name == "revenue_ytd" else f.dataType) for f in CUSTOMER_SCHEMA])
    row = list(fx.MEI_3)
    row[7] = "200000"
    spark.createDataFrame([tuple(row)], schema).write.mode("append").parquet(path)
    with pytest.raises(SchemaDriftError):
        read_customers_parquet(spark, path, strict=True)
