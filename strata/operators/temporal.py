"""Aggregates of a type 2 dimension over time, by a sweep over its intervals.

Every version adds one row and its amount to its group when it starts, and takes them away when it ends. The
changes of a group at one time are summed before they are shuffled; running sums over times
then give the group's rows and amount from each time to the next.

Running sums are taken in two levels, so that no group is one task's work: over periods (one row per group and
``period``), and within each period over its times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import EFFECTIVE_FROM, EFFECTIVE_TO
from strata.operators.aggregates import MONEY, MONEY_SUM


def over_time(
    dimension: DataFrame,
    groups: Sequence[str],
    amount: str = "revenue_ytd",
    period: str = "month",
) -> DataFrame:
    """``groups``, ``at``, ``until``, ``row_count``, ``total``: a group's state from ``at`` (included) to ``until`` (null: to date).

    ``row_count`` counts the versions valid then, ``total`` sums their amounts exactly (as ``decimal(38,2)``; null
    amounts add nothing, and amounts that are no such decimal raise). One row per group and
    time at which a version of it starts or ends, also where the sums come out as before. Versions without a start,
    and those whose interval is empty or ends before it starts, are never valid and count nowhere. A null
    group value is a group.
    """
    names = list(groups)
    clash = sorted(set(names) & {"at", "until", "row_count", "total"})
    if clash:
        raise ValueError(f"group columns named {clash}")
    value = F.coalesce(F.col(amount).cast(MONEY), F.lit(0).cast(MONEY))
    valid = F.col(EFFECTIVE_FROM).isNotNull() & (F.col(EFFECTIVE_TO).isNull() | (F.col(EFFECTIVE_TO) > F.col(EFFECTIVE_FROM)))
    start = F.struct(F.col(EFFECTIVE_FROM).alias("at"), F.lit(1).cast("long").alias("n"), value.alias("v"))
    end = F.struct(F.col(EFFECTIVE_TO).alias("at"), F.lit(-1).cast("long").alias("n"), (-value).cast(MONEY).alias("v"))
    events = dimension.where(valid).select(*names, F.inline(F.array(start, end))).where(F.col("at").isNotNull())
    steps = events.groupBy(*names, "at").agg(F.sum("n").alias("n"), F.sum("v").cast(MONEY_SUM).alias("v"))
    steps = steps.withColumn("__period", F.date_trunc(period, F.col("at").cast("timestamp_ntz")))

    by_period = Window.partitionBy(*names).orderBy("__period")
    before = by_period.rowsBetween(Window.unboundedPreceding, -1)
    periods = steps.groupBy(*names, "__period").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.min("at").alias("first_at"))
    periods = periods.select(
        *[F.col(c).alias(f"__{k}") for k, c in enumerate(names)], F.col("__period").alias("__of"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"), F.coalesce(F.sum("v").over(before), F.lit(0)).alias("__v"),
        F.lead("first_at").over(by_period).alias("__next"))

    same = F.col("__period") == F.col("__of")
    for k, c in enumerate(names):
        same = same & F.col(c).eqNullSafe(F.col(f"__{k}"))
    within = Window.partitionBy(*names, "__period").orderBy("at")
    return steps.join(periods, same).select(
        *names, "at",
        F.coalesce(F.lead("at").over(within), F.col("__next")).alias("until"),
        (F.col("__n") + F.sum("n").over(within)).alias("row_count"),
        (F.col("__v") + F.sum("v").over(within)).cast(MONEY_SUM).alias("total"))


def daily(states: DataFrame, last_day: str | None = None) -> DataFrame:
    """The states of :func:`over_time` at the start of every day: ``day`` in place of ``at`` and ``until``.

    A group's days run from its first change to ``last_day`` (default: the day of the last change of any group).
    """
    at, until = F.to_date("at"), F.to_date("until")
    first = F.date_add(at, F.when(F.col("at") > at, 1).otherwise(0))
    last = F.date_add(until, F.when(F.col("until") > until, 0).otherwise(-1))
    end = states.agg(F.max(F.to_date("at"))).scalar() if last_day is None else F.to_date(F.lit(last_day))
    kept = [c for c in states.columns if c not in ("at", "until")]
    rows = states.withColumn("__from", first).withColumn("__end", end).withColumn("__to", F.least(F.coalesce(last, "__end"), "__end"))
    return rows.where("__from <= __to").select(*kept, F.explode(F.sequence("__from", "__to")).alias("day"))
