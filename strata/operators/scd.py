"""Slowly changing dimensions.

Type 1 is the latest row per key. Type 2 keeps every version of a key with a
validity interval ``[effective_from, effective_to)`` and one current row.

The type 2 merge is a single pass over the current slice of the dimension:

1. the incoming snapshot is reduced to its latest row per key (one shuffle,
   pre-limited map-side, see :mod:`strata.operators.dedupe`);
2. the current rows with a non-null key are shuffled by key (second and last
   shuffle) and full-outer joined with it -- the deduplicated side is already
   hash-partitioned and sorted by the key, so the join adds no exchange;
3. every joined row emits zero to two output rows through
   ``inline(array(struct, ...))``: close + insert for a change, insert for a
   new key, the old row itself when unchanged or absent.

History rows (``is_current`` false) and current rows with a null key never
need a partner, so they bypass the join; a null key therefore cannot pile up
in one join task however many such rows accumulate.

Semantics match the four-branch formulation (left join, change filter, anti
join, union) for every valid state. For an invalid state with two current rows
of one key, the unchanged one is kept here (the four-branch form drops it);
:func:`strata.operators.quality.duplicate_current` detects that state.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, IntegerType

from strata.constants import (
    CUSTOMER_KEY,
    CUSTOMER_ORDER,
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    HASH_VERSION,
    HASH_VERSION_COL,
    IS_CURRENT,
    TRACKED_COLUMNS,
)
from strata.functions.columns import change_hash, row_digest
from strata.operators.dedupe import latest_per_key
from strata.schemas import SCD2_COLUMNS

#: Column that :func:`scd2_changes` adds to say what happened to each row.
CHANGE = "scd2_change"
#: Values of :data:`CHANGE`.
NEW, CHANGED, CLOSED, UNCHANGED, ABSENT = "new", "changed", "closed", "unchanged", "absent"

_N, _O = "__strata_in", "__strata_cur"


class SchemaMismatchError(ValueError):
    """The dimension and the snapshot do not have matching columns."""


# ---------------------------------------------------------------------------
# Type 1
# ---------------------------------------------------------------------------


def scd1(df: DataFrame, key: str = CUSTOMER_KEY, order: str = CUSTOMER_ORDER) -> DataFrame:
    """Type 1 dimension: the latest row per key, full recompute, no history."""
    return latest_per_key(df, key, order)


def scd1_merge(
    previous: DataFrame,
    incoming: DataFrame,
    key: str = CUSTOMER_KEY,
    order: str = CUSTOMER_ORDER,
) -> DataFrame:
    """Type 1 dimension after a new batch: equals ``scd1(previous ∪ incoming)``.

    ``previous`` already holds one row per key. The batch is reduced to its
    latest row per key and full-outer joined with it; per key the later row
    wins (greater ``order``, a null ``order`` losing to any value, then the
    greater row digest -- the same total order as :func:`scd1`). Only the
    batch is shuffled when ``previous`` is partitioned by the key (a bucketed
    table). The at most two rows without a key are reduced on their own.
    """
    if sorted(previous.columns) != sorted(incoming.columns):
        raise SchemaMismatchError("previous and incoming must have the same columns")
    cols = previous.columns
    incoming = incoming.select(*cols)
    latest = latest_per_key(incoming, key, order)
    keyed_prev = previous.filter(F.col(key).isNotNull())
    n = latest.filter(F.col(key).isNotNull()).withColumn(_N, F.lit(True))
    o = keyed_prev.withColumn(_O, F.lit(True))
    joined = n.alias("n").join(o.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"), "full_outer")
    n_order, o_order = F.col(f"n.{order}"), F.col(f"o.{order}")
    n_wins = F.col(f"n.{_N}").isNotNull() & (
        F.col(f"o.{_O}").isNull()
        | (o_order.isNull() & n_order.isNotNull())
        | (n_order > o_order)
        | (n_order.eqNullSafe(o_order) & (row_digest(cols, qualifier="n") > row_digest(cols, qualifier="o")))
    )
    winner = F.when(n_wins, F.struct(*[F.col(f"n.{c}").alias(c) for c in cols])).otherwise(
        F.struct(*[F.col(f"o.{c}").alias(c) for c in cols])
    )
    keyed = joined.select(winner.alias("__strata_row")).select("__strata_row.*")
    keyless = latest_per_key(
        previous.filter(F.col(key).isNull()).unionByName(latest.filter(F.col(key).isNull())), key, order
    )
    return keyed.unionByName(keyless)


# ---------------------------------------------------------------------------
# Slices of a type 2 dimension
# ---------------------------------------------------------------------------


def current_rows(dim: DataFrame) -> DataFrame:
    """Rows with ``is_current`` true."""
    return dim.filter(F.col(IS_CURRENT))


def history_rows(dim: DataFrame) -> DataFrame:
    """Rows with ``is_current`` false (null ``is_current`` is in neither slice)."""
    return dim.filter(~F.col(IS_CURRENT))


def with_hash_version(dim: DataFrame) -> DataFrame:
    """Backfill ``hash_version`` as a null int on tables written before it existed."""
    if HASH_VERSION_COL in dim.columns:
        return dim
    return dim.withColumn(HASH_VERSION_COL, F.lit(None).cast(IntegerType()))


def empty_dimension(source: DataFrame, order: str = CUSTOMER_ORDER) -> DataFrame:
    """An empty type 2 dimension shaped after ``source`` (first run).

    Interval columns take the type of the ordering column, so a
    ``timestamp_ntz`` source keeps ``timestamp_ntz`` intervals.
    """
    ts = source.schema[order].dataType
    return source.where(F.lit(False)).select(
        *source.columns,
        F.col(order).alias(EFFECTIVE_FROM),
        F.lit(None).cast(ts).alias(EFFECTIVE_TO),
        F.lit(None).cast(BooleanType()).alias(IS_CURRENT),
        F.lit(None).cast(IntegerType()).alias(HASH_VERSION_COL),
    )


# ---------------------------------------------------------------------------
# Type 2 merge
# ---------------------------------------------------------------------------


def _common_type(spark: SparkSession, a: DataType, b: DataType) -> DataType:
    """The type Spark's union would give two columns of types ``a`` and ``b``."""
    if a == b:
        return a
    probe = spark.range(0).select(
        F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("t")
    )
    return probe.schema["t"].dataType


def _align(
    existing: DataFrame, incoming: DataFrame, allow_missing_columns: bool
) -> tuple[DataFrame, DataFrame]:
    """Check (or pad) the column sets: existing = incoming + the SCD2 columns."""
    existing = with_hash_version(existing)
    src = [c for c in existing.columns if c not in SCD2_COLUMNS]
    missing_scd = [c for c in SCD2_COLUMNS if c not in existing.columns]
    if missing_scd:
        raise SchemaMismatchError(f"dimension lacks SCD2 columns {missing_scd}")
    only_dim = [c for c in src if c not in incoming.columns]
    only_in = [c for c in incoming.columns if c not in src]
    if only_dim or only_in:
        if not allow_missing_columns:
            raise SchemaMismatchError(
                f"columns only in the dimension: {only_dim}; only in the snapshot: {only_in}"
            )
        for c in only_in:
            existing = existing.withColumn(c, F.lit(None).cast(incoming.schema[c].dataType))
        for c in only_dim:
            incoming = incoming.withColumn(c, F.lit(None).cast(existing.schema[c].dataType))
    return existing, incoming


def _merge_keyed(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    order: str,
    tracked: Sequence[str] | None,
    compare: str,
    absent: str,
    close_absent_at: datetime | Column | None,
    late: str,
    allow_missing_columns: bool,
) -> tuple[DataFrame, DataFrame, dict[str, DataType], list[str]]:
    """Join part of the merge. Returns (merged keyed rows with :data:`CHANGE`,
    aligned existing dimension, output types, output column order)."""
    if compare not in ("hash", "struct"):
        raise ValueError("compare must be 'hash' or 'struct'")
    if absent not in ("keep", "close"):
        raise ValueError("absent must be 'keep' or 'close'")
    if late not in ("apply", "ignore"):
        raise ValueError("late must be 'apply' or 'ignore'")
    if absent == "close" and close_absent_at is None:
        raise ValueError("absent='close' needs close_absent_at")
    tracked = list(TRACKED_COLUMNS if tracked is None else tracked)

    existing, incoming = _align(existing, incoming, allow_missing_columns)
    spark = existing.sparkSession
    out_cols = existing.columns
    src_cols = [c for c in out_cols if c not in SCD2_COLUMNS]

    ex_types = {f.name: f.dataType for f in existing.schema.fields}
    in_types = {f.name: f.dataType for f in incoming.schema.fields}
    in_types[EFFECTIVE_FROM] = in_types[order]
    in_types[EFFECTIVE_TO] = ex_types[EFFECTIVE_TO]
    in_types[IS_CURRENT] = BooleanType()
    in_types[HASH_VERSION_COL] = IntegerType()
    target = {c: _common_type(spark, ex_types[c], in_types[c]) for c in out_cols}

    latest = latest_per_key(incoming.select(*src_cols), key, order)
    keyed_current = current_rows(existing).filter(F.col(key).isNotNull())

    n = latest.withColumn(_N, F.lit(True))
    o = keyed_current.withColumn(_O, F.lit(True))
    joined = n.alias("n").join(o.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"), "full_outer")

    def nc(c: str) -> Column:
        return F.col(f"n.{c}")

    def oc(c: str) -> Column:
        return F.col(f"o.{c}")

    has_n = F.col(f"n.{_N}").isNotNull()
    has_o = F.col(f"o.{_O}").isNotNull()
    if compare == "hash":
        differs = change_hash(tracked, "n") != change_hash(tracked, "o")
    else:
        differs = ~F.struct(*[nc(c).alias(c) for c in tracked]).eqNullSafe(
            F.struct(*[oc(c).alias(c) for c in tracked])
        )
    if late == "ignore":
        differs = differs & ~F.coalesce(nc(order) <= oc(EFFECTIVE_FROM), F.lit(False))

    # each column is cast once per side (only where its type differs from the
    # output type) and reused by every struct below
    def cast(values: dict[str, Column], types: dict[str, DataType]) -> dict[str, Column]:
        return {
            c: v if types.get(c) == target[c] else v.cast(target[c]).alias(c) for c, v in values.items()
        }

    inserted = cast({c: nc(c) for c in src_cols}, in_types)
    inserted.update(
        cast(
            {
                EFFECTIVE_FROM: nc(order).alias(EFFECTIVE_FROM),
                EFFECTIVE_TO: F.lit(None),
                IS_CURRENT: F.lit(True),
                HASH_VERSION_COL: F.lit(HASH_VERSION),
            },
            {EFFECTIVE_FROM: in_types[order]},
        )
    )
    kept = cast({c: oc(c) for c in out_cols}, ex_types)
    closed = dict(
        kept,
        **cast(
            {EFFECTIVE_TO: nc(order).alias(EFFECTIVE_TO), IS_CURRENT: F.lit(False)},
            {EFFECTIVE_TO: in_types[order]},
        ),
    )

    def row(values: dict[str, Column], change: str) -> Column:
        return F.struct(*[values[c] for c in out_cols], F.lit(change).alias(CHANGE))

    if absent == "close":
        at = close_absent_at if isinstance(close_absent_at, Column) else F.lit(close_absent_at)
        absent_row = row(dict(kept, **cast({EFFECTIVE_TO: at, IS_CURRENT: F.lit(False)}, {})), CLOSED)
    else:
        absent_row = row(kept, ABSENT)

    emitted = (
        F.when(has_n & ~has_o, F.array(row(inserted, NEW)))
        .when(has_n & differs, F.array(row(closed, CLOSED), row(inserted, CHANGED)))
        .when(has_n, F.array(row(kept, UNCHANGED)))
        .otherwise(F.array(absent_row))
    )
    return joined.select(F.inline(emitted)), existing, target, out_cols


def _carry(
    rows: DataFrame,
    key: str,
    target: dict[str, DataType],
    out_cols: list[str],
    absent: str,
    close_absent_at: datetime | Column | None,
) -> DataFrame:
    """Rows that bypass the join: history stays as it is; a current row with a
    null key is absent from every snapshot (kept, or closed with ``absent="close"``)."""
    keyless = F.col(IS_CURRENT) & F.col(key).isNull()
    cols = {c: F.col(c) for c in out_cols}
    if absent == "close":
        at = close_absent_at if isinstance(close_absent_at, Column) else F.lit(close_absent_at)
        cols[EFFECTIVE_TO] = F.when(keyless, at).otherwise(F.col(EFFECTIVE_TO))
        cols[IS_CURRENT] = F.when(keyless, F.lit(False)).otherwise(F.col(IS_CURRENT))
        label = F.when(keyless, F.lit(CLOSED))
    else:
        label = F.when(keyless, F.lit(ABSENT))
    types = {f.name: f.dataType for f in rows.schema.fields}
    as_is = {c for c in out_cols if types.get(c) == target[c] and c not in (EFFECTIVE_TO, IS_CURRENT)}
    return rows.select(
        *[cols[c] if c in as_is else cols[c].cast(target[c]).alias(c) for c in out_cols],
        label.alias(CHANGE),
    )


def scd2_changes(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = CUSTOMER_KEY,
    order: str = CUSTOMER_ORDER,
    tracked: Sequence[str] | None = None,
    *,
    compare: str = "hash",
    absent: str = "keep",
    close_absent_at: datetime | Column | None = None,
    late: str = "apply",
    allow_missing_columns: bool = False,
    keyless_current: DataFrame | None = None,
) -> DataFrame:
    """New state of the current slice, with a :data:`CHANGE` column per row.

    ``existing`` is the whole dimension (only its current rows are read) and
    ``incoming`` a snapshot that may hold several rows per key. Output rows:

    * ``new``       -- incoming key without a current row: inserted as current
    * ``changed``   -- new current version of a key whose tracked values differ
    * ``closed``    -- the previous version of such a key, ``effective_to`` set to
      the incoming ordering value and ``is_current`` false
    * ``unchanged`` -- current row whose incoming row has equal tracked values;
      the old row is kept as it is (old ``updated_at`` and untracked values)
    * ``absent``    -- current row whose key is not in the snapshot (no delete
      detection unless ``absent="close"``); a current row with a null key can
      never match, so it is always absent

    Options:

    * ``compare="hash"`` compares versioned SHA-256 change hashes (values cast
      to text, so ``-0.0`` differs from ``0.0`` and values containing the
      separator can collide); ``"struct"`` compares the values themselves with
      null-safe equality.
    * ``absent="close"`` closes current rows missing from the snapshot at
      ``close_absent_at``.
    * ``late="ignore"`` keeps the current row when the incoming row is not
      newer than its ``effective_from`` (default applies it anyway, which can
      give ``effective_to < effective_from``).
    * ``allow_missing_columns`` pads columns present on one side only with nulls
      instead of raising :class:`SchemaMismatchError`.
    * ``keyless_current``: current rows with a null key kept apart from
      ``existing`` (which then holds no such rows), so that a key-partitioned
      ``existing`` -- a bucketed table -- reaches the join without a shuffle.
    """
    merged, existing, target, out_cols = _merge_keyed(
        existing, incoming, key, order, tracked, compare, absent, close_absent_at, late, allow_missing_columns
    )
    if keyless_current is None:
        keyless_current = current_rows(existing).filter(F.col(key).isNull())
    else:
        keyless_current = with_hash_version(keyless_current)
    return merged.unionByName(_carry(keyless_current, key, target, out_cols, absent, close_absent_at))


def scd2_merge(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = CUSTOMER_KEY,
    order: str = CUSTOMER_ORDER,
    tracked: Sequence[str] | None = None,
    *,
    compare: str = "hash",
    absent: str = "keep",
    close_absent_at: datetime | Column | None = None,
    late: str = "apply",
    allow_missing_columns: bool = False,
) -> DataFrame:
    """The whole new dimension: untouched rows + the merged current slice.

    Rows that cannot take part in the join -- history, rows whose current flag
    is null, and current rows with a null key -- pass through in one filter over ``existing``. Column order is
    the existing dimension's. See :func:`scd2_changes` for the per-key rules
    and the options.
    """
    merged, existing, target, out_cols = _merge_keyed(
        existing, incoming, key, order, tracked, compare, absent, close_absent_at, late, allow_missing_columns
    )
    untouched = existing.filter(F.col(IS_CURRENT).isNull() | ~F.col(IS_CURRENT) | F.col(key).isNull())
    carried = _carry(untouched, key, target, out_cols, absent, close_absent_at)
    return carried.unionByName(merged).drop(CHANGE)


def scd2_merge_keyless(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = CUSTOMER_KEY,
    order: str = CUSTOMER_ORDER,
    tracked: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """:func:`scd2_merge` for the rows with a key, and a merge of its own for those without.

    Nothing tells which row without a key follows which, so such a row stands for itself: its source
    columns are its identity, and equal rows are told apart by their number only. The incoming keyless rows that the
    current ones do not hold yet (as multisets) become new current rows; those held stay as they are. The same
    snapshot merged twice therefore adds nothing, and all keyless rows of a snapshot are kept, not one of them.
    With ``absent="close"`` current keyless rows beyond those of the snapshot are closed at ``close_absent_at``.
    """
    existing, incoming = _align(existing, incoming, options.get("allow_missing_columns", False))
    source = [c for c in existing.columns if c not in SCD2_COLUMNS]
    keyless = F.col(key).isNull()
    current = keyless & F.coalesce(F.col(IS_CURRENT), F.lit(False))
    merged = scd2_merge(existing.where(~current), incoming.where(~keyless), key, order, tracked, **options)

    types = {c: merged.schema[c].dataType for c in merged.columns}
    held = existing.where(current).select(*[F.col(c).cast(types[c]).alias(c) for c in merged.columns])
    rows = incoming.where(keyless).select(*[F.col(c).cast(types[c]).alias(c) for c in source])
    opened = {EFFECTIVE_FROM: F.col(order), EFFECTIVE_TO: F.lit(None), IS_CURRENT: F.lit(True), HASH_VERSION_COL: F.lit(HASH_VERSION)}
    new = rows.exceptAll(held.select(*source)).select(*[opened.get(c, F.col(c)).cast(types[c]).alias(c) for c in merged.columns])
    if options.get("absent") == "close":
        # of equal current rows, the first ones stay
        at = options["close_absent_at"]
        at = at if isinstance(at, Column) else F.lit(at)
        counts = rows.groupBy(*source).agg(F.count(F.lit(1)).alias("__strata_wanted"))
        place = F.row_number().over(Window.partitionBy(*source).orderBy(F.col(EFFECTIVE_FROM).asc_nulls_first()))
        same = reduce(and_, [F.col(f"h.{c}").eqNullSafe(F.col(f"w.{c}")) for c in source])
        held = held.withColumn("__strata_place", place).alias("h").join(counts.alias("w"), same, "left")
        gone = F.col("__strata_place") > F.coalesce(F.col("__strata_wanted"), F.lit(0))
        closed = {EFFECTIVE_TO: F.when(gone, at), IS_CURRENT: ~gone}
        held = held.select(*[closed.get(c, F.col(f"h.{c}")).cast(types[c]).alias(c) for c in merged.columns])
    return merged.unionByName(held).unionByName(new)


# ---- the row sets of one merge, each as its own DataFrame -------------------


def new_or_changed_rows(existing: DataFrame, incoming: DataFrame, **kw) -> DataFrame:
    """Latest incoming rows whose key has no current row or whose tracked values differ."""
    return _changes_of(existing, incoming, (NEW, CHANGED), **kw).drop(*SCD2_COLUMNS)


def closed_rows(existing: DataFrame, incoming: DataFrame, **kw) -> DataFrame:
    """Current rows closed by the merge (``effective_to`` set, ``is_current`` false)."""
    return _changes_of(existing, incoming, (CLOSED,), **kw)


def inserted_rows(existing: DataFrame, incoming: DataFrame, **kw) -> DataFrame:
    """New current rows opened by the merge."""
    return _changes_of(existing, incoming, (NEW, CHANGED), **kw)


def unchanged_current_rows(existing: DataFrame, incoming: DataFrame, **kw) -> DataFrame:
    """Current rows carried forward: equal tracked values, or key not in the snapshot."""
    return _changes_of(existing, incoming, (UNCHANGED, ABSENT), **kw)


def historical_rows(existing: DataFrame) -> DataFrame:
    """History rows, retained unchanged by every merge."""
    return history_rows(with_hash_version(existing))


def _changes_of(existing: DataFrame, incoming: DataFrame, kinds: tuple[str, ...], **kw) -> DataFrame:
    changes = scd2_changes(existing, incoming, **kw)
    return changes.filter(F.col(CHANGE).isin(*kinds)).drop(CHANGE)


def apply_scd_type2(
    existing_scd2: DataFrame,
    incoming: DataFrame,
    tracked_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Customer dimension merge keyed by ``customer_id`` and ordered by ``updated_at``."""
    return scd2_merge(existing_scd2, incoming, CUSTOMER_KEY, CUSTOMER_ORDER, tracked_cols)


def apply_scd_type1(df: DataFrame) -> DataFrame:
    """Customer type 1 dimension keyed by ``customer_id`` and ordered by ``updated_at``."""
    return scd1(df, CUSTOMER_KEY, CUSTOMER_ORDER)


# ---------------------------------------------------------------------------
# Hash-version maintenance
# ---------------------------------------------------------------------------


def stale_hash_rows(dim: DataFrame, version: int = HASH_VERSION) -> DataFrame:
    """Current rows whose stored hash version is not ``version`` (null included)."""
    dim = with_hash_version(dim)
    return current_rows(dim).filter(~F.col(HASH_VERSION_COL).eqNullSafe(F.lit(version)))


def close_stale_versions(
    dim: DataFrame, at: datetime | Column, version: int = HASH_VERSION
) -> DataFrame:
    """Close current rows with a stale hash version at ``at``.

    The next merge then finds no current row for those keys and inserts their
    incoming rows as new versions under the current hash layout.
    """
    dim = with_hash_version(dim)
    at_col = at if isinstance(at, Column) else F.lit(at)
    stale = F.col(IS_CURRENT) & ~F.col(HASH_VERSION_COL).eqNullSafe(F.lit(version))
    to_type = dim.schema[EFFECTIVE_TO].dataType
    return dim.select(
        *[
            F.when(stale, at_col.cast(to_type)).otherwise(F.col(c)).alias(c)
            if c == EFFECTIVE_TO
            else F.when(stale, F.lit(False)).otherwise(F.col(c)).alias(c)
            if c == IS_CURRENT
            else F.col(c)
            for c in dim.columns
        ]
    )
