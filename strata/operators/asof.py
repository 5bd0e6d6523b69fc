"""Point-in-time lookup: for every fact the version of its key that was valid at its time.

Versions and facts of a key are sorted by time together, and each fact takes the last version before it
(``last`` ignoring nulls over the running frame): one shuffle and one sort, no join on ranges. A version
counts from ``effective_from`` (included) to ``effective_to`` (excluded).

A key with more than ``hot_rows`` rows is cut into bins of about that many by quantiles of its times, and
each bin is sorted on its own. The version that is valid when a bin starts comes from the bins' last versions
(one row per bin) and enters the bin as its first row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import CUSTOMER_KEY, EFFECTIVE_FROM, EFFECTIVE_TO
from strata.session import cut_lineage

HOT_ROWS = 1_000_000
#: Most bins of a key; beyond, bins grow.
BINS = 1000

_KEY, _AT, _FACT, _VERSION, _BIN = "__strata_key", "__strata_at", "__strata_fact", "__strata_version", "__strata_bin"


def _cuts(events: DataFrame, hot_rows: int) -> DataFrame:
    """Key and the times at which its bins start, for keys of more than ``hot_rows`` rows (at most rows / ``hot_rows`` keys)."""
    many = events.groupBy(_KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    many = cut_lineage(many)
    share = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    # the wanted number of bins out of BINS quantiles
    bins = F.least(F.ceil(F.col("n") / hot_rows), F.lit(BINS))
    step = F.floor(F.lit(BINS) / bins)
    times = events.join(many, _KEY).groupBy(_KEY).agg(
        F.percentile_approx(F.unix_micros(F.col(_AT).cast("timestamp")), share, 100 * BINS).alias("times"), F.first(step).alias("step"))
    chosen = F.array_distinct(F.filter("times", lambda t, k: (k + 1) % F.col("step") == 0))
    return times.select(F.col(_KEY).alias("__strata_hot"), chosen.alias("__strata_cuts"))


def _binned(events: DataFrame, hot_rows: int) -> DataFrame:
    """The events with their bin and, per bin of a hot key, the version valid when it starts."""
    cuts = cut_lineage(_cuts(events, hot_rows))
    place = F.size(F.filter("__strata_cuts", lambda t: t <= F.unix_micros(F.col(_AT).cast("timestamp"))))
    rows = events.join(cuts, F.col(_KEY) == F.col("__strata_hot"), "left")
    hot = F.col("__strata_cuts").isNotNull() & F.col(_AT).isNotNull()
    rows = rows.withColumn(_BIN, F.when(hot, place).otherwise(0)).drop("__strata_hot", "__strata_cuts")

    versions = rows.where(F.col(_FACT).isNull()).join(cuts, F.col(_KEY) == F.col("__strata_hot"), "left_semi")
    newest = F.max_by(_VERSION, F.struct(_AT, f"{_VERSION}.{EFFECTIVE_TO}"))
    last = versions.groupBy(_KEY, _BIN).agg(newest.alias(_VERSION))
    bins = cuts.select(F.col("__strata_hot").alias(_KEY), F.explode(F.sequence(F.lit(0), F.size("__strata_cuts"))).alias(_BIN))
    earlier = Window.partitionBy(_KEY).orderBy(_BIN).rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.join(last, [_KEY, _BIN], "left").withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(earlier))
    carried = carried.where(F.col(_VERSION).isNotNull())
    types = {f.name: f.dataType for f in rows.schema.fields}
    # a null time sorts before all others
    return rows.unionByName(carried.select(
        *[F.col(c) if c in (_KEY, _BIN, _VERSION) else F.lit(None).cast(types[c]).alias(c) for c in rows.columns]))


def as_of_join(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    fact_time: str,
    columns: Sequence[str],
    key: str = CUSTOMER_KEY,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Every fact with ``columns`` of the version of its key that was valid at its time.

    The columns are null where there is none: for a null key or time, before the first version, in a gap
    between versions, and for unknown keys. ``effective_from`` null counts as the beginning of time. Versions
    whose interval is empty or ends before it starts are never valid. In a state with overlapping
    versions, the one that started last counts. Facts are kept one to one; ``columns`` must not repeat theirs.
    ``hot_rows`` None: no key is cut (one scan fewer, for facts known to be spread).
    """
    clash = sorted(set(facts.columns) & set(columns))
    if clash:
        raise ValueError(f"columns {clash} are in the facts already; rename them first")
    spark_type = facts.schema[fact_time].dataType
    placed = F.col(fact_key).isNotNull() & F.col(fact_time).isNotNull()
    version = F.struct(*[F.col(c) for c in dict.fromkeys([*columns, EFFECTIVE_TO])])
    full = F.col(EFFECTIVE_TO).isNull() | F.col(EFFECTIVE_FROM).isNull() | (F.col(EFFECTIVE_TO) > F.col(EFFECTIVE_FROM))
    versions = dimension.where(F.col(key).isNotNull() & full).select(
        F.col(key).cast(facts.schema[fact_key].dataType).alias(_KEY), F.col(EFFECTIVE_FROM).cast(spark_type).alias(_AT), version.alias(_VERSION))
    fact = F.struct(*[F.col(c) for c in facts.columns])
    rows = facts.where(placed).select(F.col(fact_key).alias(_KEY), F.col(fact_time).alias(_AT), fact.alias(_FACT))
    events = rows.unionByName(versions, allowMissingColumns=True)
    if hot_rows is None:
        events = events.withColumn(_BIN, F.lit(0))
    else:
        events = _binned(events, hot_rows)

    by_time = Window.partitionBy(_KEY, _BIN).orderBy(
        F.col(_AT).asc_nulls_first(), F.col(_FACT).isNotNull(), F.col(f"{_VERSION}.{EFFECTIVE_TO}").asc_nulls_last())
    running = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("__strata_found", F.last(_VERSION, ignorenulls=True).over(running)).where(F.col(_FACT).isNotNull())
    end = F.col(f"__strata_found.{EFFECTIVE_TO}")
    valid: Column = end.isNull() | (F.col(_AT) < end)
    out = found.select(f"{_FACT}.*", *[F.when(valid, F.col(f"__strata_found.{c}")).alias(c) for c in columns])
    loose = facts.where(~placed)
    return out.unionByName(loose.select("*", *[F.lit(None).cast(dimension.schema[c].dataType).alias(c) for c in columns]))
