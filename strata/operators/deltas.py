"""Gold aggregates of the current customers, kept up to date by signed changes.

A merge's changes (:func:`strata.operators.scd.scd2_changes`) say which rows became current and which ceased
to be: the first add to their group's sums, the others take away. The state is one row per country and tier, the same sums that
:func:`strata.plans.layers.gold_partials` takes, so a batch reads the state and its own changes only, however many
batches there were. Amounts in whole cents are summed as decimals, so adding and taking away leaves nothing behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregates import MONEY, MONEY_SUM
from strata.operators.scd import CHANGE, CHANGED, CLOSED, NEW

GROUPS = ("country", "revenue_tier")
_SUMS = ("rows", "revenue_rows", "revenue_sum", "cents_sum", "other_rows")


def signed_partials(changes: DataFrame, revenue: str = "revenue_ytd") -> DataFrame:
    """What the changes of one merge add to (or take from) each group's sums; groups without changes have no row."""
    sign = F.when(F.col(CHANGE).isin(NEW, CHANGED), 1).when(F.col(CHANGE) == CLOSED, -1)
    rows = changes.withColumn("__sign", sign.cast("long")).where("__sign IS NOT NULL")
    amount, sign = F.col(revenue), F.col("__sign")
    cents = amount.try_cast(MONEY)
    whole = F.coalesce(cents.cast("double") == amount, F.lit(False))
    signed_cents = F.when(sign < 0, -cents).otherwise(cents).cast(MONEY)
    return rows.groupBy(*GROUPS).agg(
        F.sum(sign).alias("rows"),
        F.coalesce(F.sum(F.when(amount.isNotNull(), sign)), F.lit(0)).alias("revenue_rows"),
        F.coalesce(F.sum(amount * sign), F.lit(0.0)).alias("revenue_sum"),
        F.coalesce(F.sum(F.when(whole, signed_cents)), F.lit(0)).cast(MONEY_SUM).alias("cents_sum"),
        F.coalesce(F.sum(F.when(~whole & amount.isNotNull(), sign)), F.lit(0)).alias("other_rows"),
    )


def apply_partials(state: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The state after the changes (both one row per group); groups without rows leave it."""
    both = changes if state is None else state.unionByName(changes)
    types = {f.name: f.dataType for f in changes.schema.fields}
    sums = {c: F.sum(c).cast(types[c]) for c in _SUMS}
    for c in ("revenue_sum", "cents_sum"):  # no amounts, no sum
        sums[c] = F.when(F.sum("revenue_rows") != 0, sums[c])
    return both.groupBy(*GROUPS).agg(*[column.alias(c) for c, column in sums.items()]).where("rows <> 0")
