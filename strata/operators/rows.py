"""Row-level (narrow) operators: filters and enrichments.

None of these shuffles. Filters are simple column predicates, so Catalyst
merges consecutive ones and pushes them into the Parquet scan
(``PushedFilters``); enrichments are projections that collapse into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import full_name, revenue_tier


def keep_active(df: DataFrame, flag: str = "is_active") -> DataFrame:
    """Rows whose flag is true; false and null are both dropped."""
    return df.filter(F.col(flag))


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every listed column is non-null."""
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def with_full_name(
    df: DataFrame, first: str = "first_name", last: str = "last_name", name: str = "full_name"
) -> DataFrame:
    """Add ``full_name`` = ``first last`` (null parts skipped, never null)."""
    return df.withColumn(name, full_name(first, last))


def with_revenue_tier(
    df: DataFrame, revenue: str = "revenue_ytd", name: str = "revenue_tier", **tier_args
) -> DataFrame:
    """Add the revenue tier label (see :func:`strata.functions.revenue_tier`)."""
    return df.withColumn(name, revenue_tier(revenue, **tier_args))


# ---- names of the user / customer flows -----------------------------------


def filter_active_users(df: DataFrame) -> DataFrame:
    return keep_active(df)


def filter_active_customers(df: DataFrame) -> DataFrame:
    return keep_active(df)


def filter_valid_customers(
    df: DataFrame, key: str = "customer_id", order: str = "updated_at"
) -> DataFrame:
    """Drop rows without a key or without an ordering timestamp."""
    return require_not_null(df, (key, order))


def enrich_with_full_name(df: DataFrame) -> DataFrame:
    return with_full_name(df)


def enrich_with_revenue_tier(df: DataFrame) -> DataFrame:
    return with_revenue_tier(df)


def silver_users(bronze: DataFrame) -> DataFrame:
    """Active users with ``full_name``."""
    return with_full_name(keep_active(bronze))


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Valid, active customers with ``full_name`` and ``revenue_tier``."""
    return with_revenue_tier(with_full_name(keep_active(filter_valid_customers(bronze))))
