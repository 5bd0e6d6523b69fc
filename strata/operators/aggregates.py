"""Aggregates (gold layer).

Each is one ``groupBy``: Spark plans a partial hash aggregate before the
shuffle and a final one after it, so only one row per group and map task
crosses the network regardless of how skewed the group sizes are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(38, 2)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Row count per group; a null key value forms its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def user_count_by_country(df: DataFrame) -> DataFrame:
    """country, user_count."""
    return count_by(df, ["country"], "user_count")


def revenue_by_country(df: DataFrame, revenue: str = "revenue_ytd", exact: bool = False) -> DataFrame:
    """country, customer_count, total_revenue, avg_revenue (sum and avg rounded to 2).

    ``customer_count`` counts rows, not distinct customers; null revenue is
    skipped by sum/avg but the row is counted. ``exact=True`` sums the amounts
    as ``decimal(18,2)`` and divides in decimal (order-independent; results
    returned as doubles).
    """
    if exact:
        amount = F.col(revenue).cast(MONEY)
        # a decimal(38,2) sum makes the division round at 6 decimals, the same
        # arithmetic as the partial sums of the incremental job
        total, n = F.sum(amount).cast(MONEY_SUM), F.count(amount)
        return df.groupBy("country").agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(total, 2).cast("double").alias("total_revenue"),
            F.round(F.when(n > 0, total / n), 2).cast("double").alias("avg_revenue"),
        )
    return df.groupBy("country").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.round(F.sum(revenue), 2).alias("total_revenue"),
        F.round(F.avg(revenue), 2).alias("avg_revenue"),
    )


def revenue_by_segment(
    df: DataFrame, revenue: str = "revenue_ytd", round_to: int | None = None, exact: bool = False
) -> DataFrame:
    """country, revenue_tier, customer_count, total_revenue.

    The double sum is unrounded by default (as in the source contract), so its
    last digits depend on the order in which partitions are added. ``round_to``
    rounds it; ``exact=True`` sums the amounts as ``decimal(18,2)`` -- an exact,
    order-independent sum -- and returns it as a double.
    """
    if exact:
        total = F.sum(F.col(revenue).cast(MONEY)).cast("double")
    else:
        total = F.sum(revenue)
    if round_to is not None:
        total = F.round(total, round_to)
    return df.groupBy("country", "revenue_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        total.alias("total_revenue"),
    )


def revenue_levels(df: DataFrame, revenue: str = "revenue_ytd") -> DataFrame:
    """Both revenue golds in one scan: ``rollup(country, revenue_tier)`` keeps the
    (country, tier) and (country) levels, told apart by ``level`` (0 and 1).

    Columns: country, revenue_tier, level, customer_count, revenue_sum,
    revenue_avg (double sum and average, unrounded). One shuffle of a partial
    aggregate, like each single aggregate; split with :func:`split_revenue_levels`.
    """
    return (
        df.rollup("country", "revenue_tier")
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("customer_count"),
            F.sum(revenue).alias("revenue_sum"),
            F.avg(revenue).alias("revenue_avg"),
        )
        .filter(F.col("level") < 2)
    )


def split_revenue_levels(levels: DataFrame) -> dict[str, DataFrame]:
    """The two gold tables, shaped as :func:`revenue_by_country` / :func:`revenue_by_segment`."""
    by_country = levels.filter(F.col("level") == 1).select(
        "country",
        "customer_count",
        F.round("revenue_sum", 2).alias("total_revenue"),
        F.round("revenue_avg", 2).alias("avg_revenue"),
    )
    by_segment = levels.filter(F.col("level") == 0).select(
        "country", "revenue_tier", "customer_count", F.col("revenue_sum").alias("total_revenue")
    )
    return {"gold_revenue_by_country": by_country, "gold_revenue_by_segment": by_segment}


# names of the user / customer flows
aggregate_user_count_by_country = user_count_by_country
aggregate_revenue_by_country = revenue_by_country
aggregate_revenue_by_segment = revenue_by_segment
