"""Queries that go through files, jobs, the store and the catalog, and read back what these wrote.

Each writes below a folder of its own in the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.rows import silver_customers
from strata.operators.scd import empty_dimension, scd2_changes
from strata.operators.deltas import apply_partials, signed_partials
from strata.plans.layers import customer_dimension, golds_from_partials, run_customer_batch, run_customer_job, run_user_job
from strata.plans.named import merge_and_publish
from strata.plans.store import DimensionStore
from strata.schemas import CUSTOMER_SCHEMA
from strata.session import checkpoint_root, cut_lineage
from strata.sources.files import read_customers_parquet, read_users_csv
from strata.sources.quarantine import REASON, RECORD, read_users_csv_with_rejects
from strata.sources.tables import customer_states, snapshot, table, users


def _folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/strata-round-trips/{label}-{uuid.uuid4().hex}"


def _as_landed(rows: DataFrame) -> DataFrame:
    """Customer rows in the schema of the customer source (times with a zone)."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CUSTOMER_SCHEMA.fields])


def _as_stored(rows: DataFrame) -> DataFrame:
    """Times without a zone, as the test tables have them."""
    zoned = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"]
    return rows.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in rows.columns])


def _users_csv(spark: SparkSession, d: str) -> str:
    path = _folder(spark, "users-csv")
    users(spark, d).write.option("header", "true").csv(path)
    return path


def users_csv(spark: SparkSession, d: str) -> DataFrame:
    return read_users_csv(spark, _users_csv(spark, d), strict=True)


def user_job(spark: SparkSession, d: str) -> DataFrame:
    """Gold of the user job over a CSV landing file."""
    paths = run_user_job(spark, _users_csv(spark, d), _folder(spark, "user-job"))
    return spark.read.parquet(paths["gold_user_count_by_country"])


def _landed(spark: SparkSession, d: str, numbers: tuple[int, ...] = (1, 2, 3)) -> list[str]:
    paths = []
    for n in numbers:
        paths.append(_folder(spark, f"customers-{n}"))
        _as_landed(snapshot(spark, d, n)).write.parquet(paths[-1])
    return paths


def customers_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "customers")
    _as_landed(customer_states(spark, d)).write.parquet(path)
    return _as_stored(read_customers_parquet(spark, path, strict=True))


def customer_job(spark: SparkSession, d: str) -> DataFrame:
    """The dimension after three runs of the customer job, one per landing folder."""
    warehouse = _folder(spark, "customer-job")
    for path in _landed(spark, d):
        run_customer_job(spark, path, warehouse, strict=True)
    schema = silver_customers(read_customers_parquet(spark, path)).schema
    return _as_stored(customer_dimension(spark, warehouse, schema).read())


def customer_batches_gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold by country after two incremental batches (snapshots 2 and 3 hold every row once)."""
    warehouse = _folder(spark, "customer-batches")
    for batch, path in enumerate(_landed(spark, d, (2, 3)), 1):
        run_customer_batch(spark, path, warehouse, batch)
    return spark.read.parquet(f"{warehouse}/gold_revenue_by_country")


def _stored_merges(spark: SparkSession, d: str, buckets: int | None = None) -> tuple[DimensionStore, list[DataFrame]]:
    snaps = [silver_customers(snapshot(spark, d, n)) for n in (1, 2, 3)]
    schema = empty_dimension(snaps[0]).schema
    return DimensionStore(spark, _folder(spark, "store"), schema, buckets=buckets), snaps


def store_merges(spark: SparkSession, d: str) -> DataFrame:
    """Three merges of a bucketed store, read back."""
    store, snaps = _stored_merges(spark, d, buckets=8)
    for batch, snap in enumerate(snaps):
        store.merge(snap, batch_id=batch)
    return store.read()


def named_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Three merges, read by the dimension's name in the catalog."""
    store, snaps = _stored_merges(spark, d)
    name = f"dim_customers_scd2_{uuid.uuid4().hex[:8]}"
    for batch, snap in enumerate(snaps):
        merge_and_publish(store, snap, name, "Customer history (type 2)", batch_id=batch)
    return spark.table(name)


def golds_by_changes(spark: SparkSession, d: str) -> DataFrame:
    """Revenue of the current customers by country and tier, from the changes of three merges."""
    dimension = state = None
    for n in (1, 2, 3):
        snap = silver_customers(snapshot(spark, d, n))
        dimension = empty_dimension(snap) if dimension is None else dimension
        # the current slice and what the merge closed; history is not needed here
        changes = cut_lineage(scd2_changes(dimension, snap))
        state = cut_lineage(apply_partials(state, signed_partials(changes)))
        dimension = changes.drop("scd2_change")
    return golds_from_partials(state)["gold_revenue_by_segment"]


def users_csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Users written as CSV with damage by key, read back with the reasons of rejected rows."""
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, F.concat(F.lit('"a, '), F.col("c_name"), F.lit('\nb"'))).otherwise(F.col("c_name"))
    flag = F.when(k % 13 == 0, "perhaps").otherwise(F.when(F.col("c_acctbal") > 0, "true").otherwise("false"))
    fields = F.concat_ws(",", k.cast("string"), name, F.lit(""), F.col("c_mktsegment"))
    line = F.when(k % 7 == 0, fields).when(k % 11 == 0, F.concat_ws(",", fields, flag, F.lit("more"))).otherwise(F.concat_ws(",", fields, flag))
    path = _folder(spark, "users-damaged")
    table(spark, d, "customer").select(line.alias("value")).write.text(path)
    rows = read_users_csv_with_rejects(spark, path, header=False, multi_line=True)
    return rows.select("id", "first_name", "last_name", "country", "is_active", F.col(RECORD).alias("record"), F.col(REASON).alias("reason"))
