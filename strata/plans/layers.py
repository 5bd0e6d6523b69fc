"""Bronze / silver / gold layers for the user and customer flows.

``user_layers`` / ``customer_layers`` return the lazy DataFrames of every
dataset; ``compute_dataset`` computes one from its upstream datasets by name.
``run_user_job`` / ``run_customer_job`` materialize them in dependency order
(a full refresh, as materialized views are): every layer is written to its own
folder and the next layer reads it back, so each step starts from stored
Parquet (lineage is cut at every layer, a lost executor only recomputes the
current step) and the four consumers of silver share one stored copy.
``run_customer_batch`` is the incremental form for one new batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import CUSTOMER_KEY
from strata.operators.aggregates import (
    MONEY,
    revenue_by_country,
    revenue_by_segment,
    revenue_levels,
    split_revenue_levels,
    user_count_by_country,
)
from strata.operators.rows import (
    filter_valid_customers,
    silver_customers,
    silver_users,
    with_full_name,
    with_revenue_tier,
)
from strata.operators.scd import scd1, scd1_merge, scd2_merge
from strata.plans.store import Commit, DimensionStore, VersionedTable
from strata.schemas import scd2_schema
from strata.sources.files import read_customers_parquet, read_users_csv


@dataclass(frozen=True)
class Dataset:
    name: str
    kind: str  # "table" (stored, appended by ingestion) or "materialized_view" (recomputed)
    comment: str


USER_DATASETS = (
    Dataset("bronze_users", "table", "User rows as read from the CSV source, unchanged."),
    Dataset("silver_active_users", "materialized_view", "Active users with a full_name column."),
    Dataset("gold_user_count_by_country", "materialized_view", "Number of active users per country."),
)

CUSTOMER_DATASETS = (
    Dataset("bronze_customers", "table", "Customer snapshot rows as read from Parquet, unchanged."),
    Dataset(
        "silver_valid_customers",
        "materialized_view",
        "Customers with a key and a timestamp, active, with full_name and revenue_tier.",
    ),
    Dataset(
        "gold_revenue_by_country",
        "materialized_view",
        "Row count, total and average revenue (rounded to cents) per country.",
    ),
    Dataset(
        "gold_revenue_by_segment",
        "materialized_view",
        "Row count and total revenue per country and revenue tier.",
    ),
    Dataset("dim_customers_scd1", "table", "Latest state per customer_id; no history."),
    Dataset(
        "dim_customers_scd2",
        "table",
        "Every version per customer_id with effective_from / effective_to (null while current) and is_current.",
    ),
)


def user_layers(bronze: DataFrame) -> dict[str, DataFrame]:
    silver = silver_users(bronze)
    return {
        "bronze_users": bronze,
        "silver_active_users": silver,
        "gold_user_count_by_country": user_count_by_country(silver),
    }


def customer_layers(bronze: DataFrame, existing_scd2: DataFrame | None = None) -> dict[str, DataFrame]:
    """All customer datasets; ``dim_customers_scd2`` only when a prior state is given."""
    silver = silver_customers(bronze)
    layers = {
        "bronze_customers": bronze,
        "silver_valid_customers": silver,
        "gold_revenue_by_country": revenue_by_country(silver),
        "gold_revenue_by_segment": revenue_by_segment(silver),
        "dim_customers_scd1": scd1(silver),
    }
    if existing_scd2 is not None:
        layers["dim_customers_scd2"] = scd2_merge(existing_scd2, silver)
    return layers


# ---------------------------------------------------------------------------
# Datasets resolved by name
# ---------------------------------------------------------------------------


def compute_dataset(spark: SparkSession, name: str, **sources: str) -> DataFrame:
    """Compute one dataset from its upstream datasets looked up with ``spark.table``.

    This is how a pipeline runner (or a test with temp views as stand-ins)
    evaluates a layer: ``silver_active_users`` reads the table or view named
    ``bronze_users``, the golds and both dimensions read
    ``silver_valid_customers``, and ``dim_customers_scd2`` reads its previous
    state from the table named ``dim_customers_scd2``. Bronze datasets read
    their file source from ``users_csv`` / ``customers_parquet`` keyword paths.
    """
    table = spark.table
    computations = {
        "bronze_users": lambda: read_users_csv(spark, sources["users_csv"]),
        "silver_active_users": lambda: silver_users(table("bronze_users")),
        "gold_user_count_by_country": lambda: user_count_by_country(table("silver_active_users")),
        "bronze_customers": lambda: read_customers_parquet(spark, sources["customers_parquet"]),
        "silver_valid_customers": lambda: silver_customers(table("bronze_customers")),
        "gold_revenue_by_country": lambda: revenue_by_country(table("silver_valid_customers")),
        "gold_revenue_by_segment": lambda: revenue_by_segment(table("silver_valid_customers")),
        "dim_customers_scd1": lambda: scd1(table("silver_valid_customers")),
        "dim_customers_scd2": lambda: scd2_merge(table("dim_customers_scd2"), table("silver_valid_customers")),
    }
    if name not in computations:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(computations)}")
    return computations[name]()


# ---------------------------------------------------------------------------
# Batch jobs
# ---------------------------------------------------------------------------


def _path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def _materialize(spark: SparkSession, df: DataFrame, warehouse: str, ds: Dataset, register: bool) -> DataFrame:
    path = _path(warehouse, ds.name)
    df.write.mode("overwrite").parquet(path)
    if register:
        if spark.catalog.tableExists(ds.name):
            spark.catalog.refreshTable(ds.name)
        else:
            spark.catalog.createTable(ds.name, path=path, source="parquet", description=ds.comment)
    return spark.read.schema(df.schema).parquet(path)


def _materialize_path(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_user_job(
    spark: SparkSession, source_csv: str, warehouse: str, *, strict: bool = False, register: bool = False
) -> dict[str, str]:
    """CSV -> bronze -> silver -> gold, each stored under ``warehouse/<name>``."""
    ds = {d.name: d for d in USER_DATASETS}
    bronze = _materialize(spark, read_users_csv(spark, source_csv, strict=strict), warehouse, ds["bronze_users"], register)
    silver = _materialize(spark, silver_users(bronze), warehouse, ds["silver_active_users"], register)
    _materialize(spark, user_count_by_country(silver), warehouse, ds["gold_user_count_by_country"], register)
    return {name: _path(warehouse, name) for name in ds}


def _require_mode(spark: SparkSession, warehouse: str, mode: str) -> None:
    """Record how a warehouse is kept, and raise if it is kept the other way: the two jobs lay
    out the golds and the type 1 dimension differently, and each would lose the other's rows. Raises
    also for a warehouse that holds customer data but no such record."""

    def read(name: str, source: str) -> DataFrame | None:
        try:
            return spark.read.format(source).load(_path(warehouse, name))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    path = _path(warehouse, "_mode")
    mark = read("_mode", "text")
    found = [r.value for r in mark.collect()] if mark is not None else []
    if not found:
        if read("bronze_customers", "binaryFile") is not None:
            raise ValueError(f"{warehouse} holds customer data but no {path}; write the mode of the jobs that keep it there")
        spark.range(1).select(F.lit(mode).alias("value")).write.mode("overwrite").text(path)
    elif set(found) != {mode}:
        raise ValueError(f"{warehouse} is kept by {found[0]} jobs; use another warehouse for {mode} jobs")


def run_customer_job(
    spark: SparkSession,
    source_parquet: str,
    warehouse: str,
    *,
    batch_id: int | None = None,
    strict: bool = False,
    register: bool = False,
    scd2_buckets: int | None = None,
    track_deactivation: bool = False,
    exact_money: bool = False,
    **scd2_options,
) -> Commit:
    """Parquet -> bronze -> silver -> golds, SCD1, and one SCD2 merge.

    Both golds come from one scan of silver: a ``rollup`` over (country, tier)
    whose small result is stored once and split. ``exact_money`` uses the
    partial sums the incremental job stores instead (exact decimal sums).

    The SCD2 dimension lives in a :class:`DimensionStore` under
    ``warehouse/dim_customers_scd2``; the returned commit names the new version.
    ``scd2_buckets`` keeps its current slice bucketed by ``customer_id`` so a
    merge shuffles only the incoming snapshot. By default the dimension is fed
    from silver (active customers only), so a deactivated customer just stops
    arriving and its last active version stays current; with
    ``track_deactivation`` it is fed from all valid rows and ``is_active``
    changes become versions like any other tracked change.
    """
    _require_mode(spark, warehouse, "full refresh")
    ds = {d.name: d for d in CUSTOMER_DATASETS}
    bronze_src = read_customers_parquet(spark, source_parquet, strict=strict)
    bronze = _materialize(spark, bronze_src, warehouse, ds["bronze_customers"], register)
    silver = _materialize(spark, silver_customers(bronze), warehouse, ds["silver_valid_customers"], register)
    if exact_money:
        partials = _materialize_path(spark, gold_partials(silver, exact=True), _path(warehouse, _PARTIALS + "_full"))
        for name, gold in golds_from_partials(partials).items():
            _materialize(spark, gold, warehouse, ds[name], register)
    else:
        levels = _materialize_path(spark, revenue_levels(silver), _path(warehouse, "_gold_levels"))
        for name, gold in split_revenue_levels(levels).items():
            _materialize(spark, gold, warehouse, ds[name], register)
    _materialize(spark, scd1(silver), warehouse, ds["dim_customers_scd1"], register)
    store = customer_dimension(spark, warehouse, silver.schema, buckets=scd2_buckets)
    scd2_input = with_revenue_tier(with_full_name(filter_valid_customers(bronze))) if track_deactivation else silver
    return store.merge(scd2_input, batch_id=batch_id, **scd2_options)


# ---------------------------------------------------------------------------
# Incremental customer job
# ---------------------------------------------------------------------------

BATCH = "batch_id"
_PARTIALS = "_gold_partials"


def _write_batch(spark: SparkSession, df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Store this batch's rows under ``path/batch_id=<id>`` -- replacing only that batch,
    so re-running a batch is idempotent -- and return them as stored."""
    batch_path = f"{path}/{BATCH}={batch_id}"
    df.write.mode("overwrite").parquet(batch_path)
    return spark.read.schema(df.schema).parquet(batch_path)


def _read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def gold_partials(silver: DataFrame, revenue: str = "revenue_ytd", exact: bool = False) -> DataFrame:
    """Additive per-batch state of both golds, per country and tier: rows, rows with a revenue, its
    sum as it is, and the exact sum of the amounts in whole cents with the number of the others
    (fractions of a cent, NaN, too large). ``exact`` takes every amount to cents, and raises where one does not fit."""
    amount = F.col(revenue)
    cents = amount.cast(MONEY) if exact else amount.try_cast(MONEY)
    whole = F.lit(True) if exact else F.coalesce(cents.cast("double") == amount, F.lit(False))
    return silver.groupBy("country", "revenue_tier").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(amount).alias("revenue_rows"),
        F.sum(amount).alias("revenue_sum"),
        F.sum(F.when(whole, cents)).alias("cents_sum"),
        F.count(F.when(~whole, amount)).alias("other_rows"),
    )


def golds_from_partials(partials: DataFrame) -> dict[str, DataFrame]:
    """Both golds from accumulated partials (a few rows per batch and group)."""
    # exact where every amount is in whole cents, else the plain sum
    total = F.when(F.sum("other_rows") == 0, F.sum("cents_sum").cast("double")).otherwise(F.sum("revenue_sum"))
    n = F.sum("revenue_rows")
    by_country = partials.groupBy("country").agg(
        F.sum("rows").alias("customer_count"),
        F.round(total, 2).cast("double").alias("total_revenue"),
        F.round(F.when(n > 0, total / n), 2).cast("double").alias("avg_revenue"),
    )
    by_segment = partials.groupBy("country", "revenue_tier").agg(
        F.sum("rows").alias("customer_count"),
        total.cast("double").alias("total_revenue"),
    )
    return {"gold_revenue_by_country": by_country, "gold_revenue_by_segment": by_segment}


def customer_scd1_table(
    spark: SparkSession, warehouse: str, silver_schema, buckets: int | None = None
) -> VersionedTable:
    """The type 1 dimension of the incremental job (one whole version per batch,
    optionally bucketed by ``customer_id``)."""
    return VersionedTable(
        spark, _path(warehouse, "dim_customers_scd1"), silver_schema, key=CUSTOMER_KEY, buckets=buckets
    )


def run_customer_batch(
    spark: SparkSession,
    source_parquet: str | DataFrame,
    warehouse: str,
    batch_id: int,
    *,
    strict: bool = False,
    scd2_buckets: int | None = None,
    report_late: bool = True,
    **scd2_options,
) -> Commit:
    """Incremental form of :func:`run_customer_job` for a source holding one new batch
    (a Parquet path, or the batch as a DataFrame -- e.g. a stream's micro-batch).

    Work per batch grows with the batch and the current dimension, not with
    everything ever loaded: bronze and silver get the batch appended under
    ``batch_id=<id>``; the golds are re-aggregated from stored per-batch
    partial sums (exact where all amounts are in whole cents, so the order of batches
    does not matter); the type 1 dimension is merged with the batch
    (:func:`strata.operators.scd.scd1_merge`); the type 2 dimension merges the
    batch. With ``scd2_buckets`` both dimensions are kept bucketed by key, so
    only the batch is shuffled. Every step can be re-run for the same
    ``batch_id``: batch folders are replaced, committed versions skipped. The
    batch's late rows (not newer than the current version of their key) are
    written to ``_quality/late_rows/batch_id=<id>`` before the merge unless
    ``report_late`` is false (the report costs one more join of the batch).

    For batches that arrive in order the datasets equal a full refresh over
    all batches. A batch that is older than the current versions is applied
    as late data by the SCD2 merge; pass ``late="ignore"`` to keep the newer
    versions (what a full refresh would do).
    """
    _require_mode(spark, warehouse, "incremental")
    ds = {d.name: d for d in CUSTOMER_DATASETS}
    bronze_path, silver_path = _path(warehouse, "bronze_customers"), _path(warehouse, "silver_valid_customers")
    source = (
        source_parquet
        if isinstance(source_parquet, DataFrame)
        else read_customers_parquet(spark, source_parquet, strict=strict)
    )
    bronze = _write_batch(spark, source, bronze_path, batch_id)
    silver = _write_batch(spark, silver_customers(bronze), silver_path, batch_id)
    partials_path = _path(warehouse, _PARTIALS)
    partials = _write_batch(spark, gold_partials(silver), partials_path, batch_id)
    for name, gold in golds_from_partials(_read_batches(spark, partials_path, partials.schema)).items():
        _materialize(spark, gold, warehouse, ds[name], register=False)

    scd1_table = customer_scd1_table(spark, warehouse, silver.schema, buckets=scd2_buckets)
    scd1_commits = scd1_table.commits()
    if scd1_table.committed_batch(batch_id, scd1_commits) is None:
        previous = scd1_table.read_version(commits=scd1_commits) if scd1_commits else None
        new_state = scd1(silver) if previous is None else scd1_merge(previous, silver)
        scd1_table.write_version(new_state, batch_id, commits=scd1_commits)

    store = customer_dimension(spark, warehouse, silver.schema, buckets=scd2_buckets)
    if report_late and store.committed_batch(batch_id) is None and store.latest() is not None:
        # rows the merge applies as late data (or keeps out with late="ignore"), per batch
        _write_batch(spark, store.late_rows(silver), _path(warehouse, "_quality/late_rows"), batch_id)
    return store.merge(silver, batch_id=batch_id, **scd2_options)


def customer_dimension(
    spark: SparkSession, warehouse: str, silver_schema, buckets: int | None = None
) -> DimensionStore:
    """The SCD2 store of the customer flow."""
    return DimensionStore(spark, _path(warehouse, "dim_customers_scd2"), scd2_schema(silver_schema), buckets=buckets)
