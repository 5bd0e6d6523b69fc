"""Drop-in names for code written against the user / customer flow API.

Every name maps onto a strata operator; nothing here has logic of its own.
The steps of the SCD2 merge work on one joined frame with struct columns ``new`` and ``old``
(:mod:`strata.operators.steps`), whose fields have the same names as those of an aliased join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from strata.constants import (  # noqa: F401
    GOLD_THRESHOLD,
    HASH_VERSION,
    PLATINUM_THRESHOLD,
    SCD2_TRACKED_COLUMNS,
    SILVER_THRESHOLD,
)
from strata.functions.columns import change_hash
from strata.operators.aggregates import (  # noqa: F401
    aggregate_revenue_by_country,
    aggregate_revenue_by_segment,
    aggregate_user_count_by_country,
)
from strata.operators.dedupe import deduplicate_by_latest  # noqa: F401
from strata.operators.rows import (  # noqa: F401
    enrich_with_full_name,
    enrich_with_revenue_tier,
    filter_active_customers,
    filter_active_users,
    filter_valid_customers,
)
from strata.operators.scd import (  # noqa: F401
    apply_scd_type1,
    apply_scd_type2,
    current_rows,
    history_rows,
)
from strata.operators import steps
from strata.operators.steps import (  # noqa: F401
    detect_changed_or_new,
    get_unchanged_current_rows,
    join_incoming_with_current,
)
from strata.plans.layers import compute_dataset
from strata.schemas import CUSTOMER_PARQUET_SCHEMA, USER_CSV_SCHEMA  # noqa: F401
from strata.sources.files import read_customers_parquet, read_users_csv  # noqa: F401


def build_change_hash(alias: str, tracked_cols: Sequence[str]) -> Column:
    return change_hash(tracked_cols, qualifier=alias)


def get_current_active(existing_scd2: DataFrame) -> DataFrame:
    return current_rows(existing_scd2)


def get_historical_rows(existing_scd2: DataFrame) -> DataFrame:
    return history_rows(existing_scd2)


def build_closed_rows(changed_or_new: DataFrame, existing_scd2: DataFrame) -> DataFrame:
    return steps.build_closed_rows(changed_or_new).select(*existing_scd2.columns)


def build_inserted_rows(changed_or_new: DataFrame, latest_incoming: DataFrame) -> DataFrame:
    inserted = steps.build_inserted_rows(changed_or_new)
    return inserted.select(*latest_incoming.columns, *inserted.columns[-4:])


def _dataset(name: str):
    def compute(spark: SparkSession) -> DataFrame:
        return compute_dataset(spark, name)

    compute.__name__ = f"compute_{name}"
    return compute


compute_silver_active_users = _dataset("silver_active_users")
compute_gold_user_count_by_country = _dataset("gold_user_count_by_country")
compute_silver_valid_customers = _dataset("silver_valid_customers")
compute_gold_revenue_by_country = _dataset("gold_revenue_by_country")
compute_gold_revenue_by_segment = _dataset("gold_revenue_by_segment")
compute_dim_customers_scd1 = _dataset("dim_customers_scd1")
compute_dim_customers_scd2 = _dataset("dim_customers_scd2")
