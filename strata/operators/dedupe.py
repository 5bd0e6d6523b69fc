"""Latest row per key.

``row_number() = 1`` over ``partition by key order by order desc, digest desc``.
Catalyst rewrites the filter into a WindowGroupLimit that runs once before the
shuffle (each map task keeps one row per key) and once after it, so a hot key
-- even one holding a third of the input -- sends at most one row per map task
to the reducer. The digest of all columns makes the winner among equal
``order`` values deterministic and independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import row_digest
from strata.session import cut_lineage

_RANK = "__strata_rank"


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
) -> DataFrame:
    """One row per key: the greatest ``order`` value, ties broken by row digest.

    ``desc`` puts nulls last, so a null ``order`` only wins when every row of
    the key has one. Rows with a null key form a single group and keep one row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if _RANK in df.columns:
        raise ValueError(f"input must not contain a column named {_RANK}")
    tie = row_digest(df.columns)
    window = Window.partitionBy(*keys).orderBy(F.col(order).desc(), tie.desc())
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def latest_by_aggregate(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
) -> DataFrame:
    """The rows of :func:`latest_per_key`, by aggregation: no sort by digests, and digests of tied rows only.

    The first pass keeps, per key, one of the rows with the greatest ``order`` and tells whether there are
    several (their first and last number differ). Keys with several, if any, are looked up again: their rows at that
    ``order`` are digested and the greatest wins. Both passes aggregate before the shuffle, so neither a hot key
    nor a hot tie reaches one task as more than a row per map task. The tied keys are written first, so Spark knows
    whether to broadcast them. It reads ``df`` a second time where rows tie, which pays when rows are wide or ties rare;
    otherwise the window of :func:`latest_per_key` reads once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    row, number = F.struct(*df.columns), F.monotonically_increasing_id()
    numbered = df.select(*[F.col(c).alias(f"__strata_key{k}") for k, c in enumerate(keys)], F.col(order).alias("__strata_order"),
                         number.alias("__strata_number"), row.alias("__strata_row"))
    names = numbered.columns[: len(keys)]
    by_number = F.struct("__strata_order", "__strata_number")
    top = cut_lineage(numbered.groupBy(*names).agg(
        F.max_by("__strata_row", by_number).alias("__strata_row"),
        F.max(by_number).alias("__strata_last"),
        F.max(F.struct("__strata_order", (-F.col("__strata_number")).alias("n"))).alias("__strata_first")))
    several = F.col("__strata_last.__strata_number") != -F.col("__strata_first.n")
    single = top.where(~several).select("__strata_row.*")
    tied = cut_lineage(top.where(several).select(*names, F.col("__strata_last.__strata_order").alias("__strata_order")))
    same = F.col(order).eqNullSafe(F.col("__strata_order"))
    for c, name in zip(keys, names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(name))
    found = df.join(tied, same).withColumn("__strata_digest", row_digest(df.columns))
    best = found.groupBy(*names).agg(F.max_by(row, "__strata_digest").alias("__strata_row"))
    return single.unionByName(best.select("__strata_row.*"))


# name used by the customer flows
def deduplicate_by_latest(df: DataFrame, key_col: str, order_col: str) -> DataFrame:
    return latest_per_key(df, key_col, order_col)
