"""Data-quality checks on layers and dimensions, all returned as DataFrames.

Each check is a filter or one aggregate, so it runs distributed and only its
(small) result is ever looked at by the caller; nothing is collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import (
    CUSTOMER_KEY,
    CUSTOMER_ORDER,
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    HASH_VERSION,
    HASH_VERSION_COL,
    IS_CURRENT,
)
from strata.operators.dedupe import latest_per_key
from strata.operators.scd import current_rows, with_hash_version


def duplicate_keys(df: DataFrame, key: str = CUSTOMER_KEY, name: str = "cnt") -> DataFrame:
    """Key values (null included) that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def duplicate_current(dim: DataFrame, key: str = CUSTOMER_KEY) -> DataFrame:
    """Keys with more than one current row (an invalid SCD2 state)."""
    return duplicate_keys(current_rows(dim), key)


def key_uniqueness(df: DataFrame, key: str = CUSTOMER_KEY) -> DataFrame:
    """One row: ``rows``, ``distinct_keys`` (null counted as a value), ``is_unique``."""
    k = F.col(key)
    return (
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            (
                F.count_distinct(k)
                + F.max(F.when(k.isNull(), F.lit(1)).otherwise(F.lit(0)))
            ).alias("distinct_keys"),
        )
        .withColumn("distinct_keys", F.coalesce(F.col("distinct_keys"), F.lit(0)).cast("bigint"))
        .withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))
    )


def null_keys(df: DataFrame, key: str = CUSTOMER_KEY) -> DataFrame:
    """Rows without a key (they never match in a merge and are re-inserted each run)."""
    return df.filter(F.col(key).isNull())


def interval_violations(dim: DataFrame) -> DataFrame:
    """Rows whose validity interval ends before it starts (late data applied)."""
    return dim.filter(F.col(EFFECTIVE_TO) < F.col(EFFECTIVE_FROM))


def open_history(dim: DataFrame) -> DataFrame:
    """Closed rows without an end, or current rows with one."""
    return dim.filter(
        (~F.col(IS_CURRENT) & F.col(EFFECTIVE_TO).isNull())
        | (F.col(IS_CURRENT) & F.col(EFFECTIVE_TO).isNotNull())
    )


def late_rows(
    dim: DataFrame, incoming: DataFrame, key: str = CUSTOMER_KEY, order: str = CUSTOMER_ORDER
) -> DataFrame:
    """Latest incoming rows that are not newer than the current version of their key.

    A merge applies them anyway (closing the current row before it starts)
    unless ``late="ignore"``; run this before a merge to see them. Output: the
    incoming row plus ``current_effective_from``. One shuffle per side by key;
    keys are unique on both sides after deduplication, so no key can skew it.
    """
    latest = latest_per_key(incoming, key, order)
    current = current_rows(dim).filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__late_key"), F.col(EFFECTIVE_FROM).alias("current_effective_from")
    )
    joined = latest.join(current, latest[key] == current["__late_key"], "inner")
    return joined.filter(F.col(order) <= F.col("current_effective_from")).drop("__late_key")


def null_current_flags(dim: DataFrame) -> DataFrame:
    """Rows with a null ``is_current``: a merge reads them as neither current nor history."""
    return dim.filter(F.col(IS_CURRENT).isNull())


def dimension_report(dim: DataFrame, key: str = CUSTOMER_KEY, version: int = HASH_VERSION) -> DataFrame:
    """One-row health summary of an SCD2 dimension.

    Columns: rows, current_rows, history_rows, null_key_rows,
    null_is_current_rows, interval_violations, open_history_rows,
    stale_hash_rows, duplicate_current_keys.

    Two chained aggregates. Only current rows need grouping by key (to find
    keys with two current rows); every other row is grouped by the task that
    reads it, so the partial aggregate before the shuffle folds all history of
    a task into one row and the history is never shuffled row by row.
    """
    dim = with_hash_version(dim)
    cur, ef, et = F.col(IS_CURRENT), F.col(EFFECTIVE_FROM), F.col(EFFECTIVE_TO)

    def n(cond):
        return F.count(F.when(cond, F.lit(1)))

    is_cur = F.coalesce(cur, F.lit(False))
    per_group = dim.groupBy(
        F.when(is_cur, F.col(key)).alias("_key"),
        F.when(~is_cur, F.spark_partition_id()).alias("_task"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        n(cur).alias("current_rows"),
        n(~cur).alias("history_rows"),
        n(F.col(key).isNull()).alias("null_key_rows"),
        n(cur.isNull()).alias("null_is_current_rows"),
        n(et < ef).alias("interval_violations"),
        n((~cur & et.isNull()) | (cur & et.isNotNull())).alias("open_history_rows"),
        n(cur & ~F.col(HASH_VERSION_COL).eqNullSafe(F.lit(version))).alias("stale_hash_rows"),
    )
    sums = [
        "rows",
        "current_rows",
        "history_rows",
        "null_is_current_rows",
        "interval_violations",
        "open_history_rows",
        "stale_hash_rows",
        "null_key_rows",
    ]
    return per_group.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in sums],
        F.count(F.when(F.col("_task").isNull() & (F.col("current_rows") > 1), F.lit(1))).alias(
            "duplicate_current_keys"
        ),
    )
