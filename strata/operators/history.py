"""Type 2 history from rows in any order.

:func:`strata.operators.scd.scd2_merge` takes one row per key, the latest, and applies it at the end of the
key's history. The two merges here place every row by its time instead:

* :func:`scd2_merge_versions` takes all rows of an in-order batch: a key's rows become a
  chain of versions behind its current one.
* :func:`scd2_splice` also takes rows older than the current version. The history of the
  keys it touches is rebuilt, so any order of arrival gives the history of the ordered rows.

Both sort a key's events by time once and work on neighbours:

1. of rows with the same key and time one stays, that of the greatest row digest (the tie-break
   of :func:`strata.operators.dedupe.latest_per_key`);
2. consecutive rows with equal tracked values are an island; its first row is a version, the
   others only confirm it;
3. a version ends where the next one starts, or where the key was closed before that (``absent="close"``,
   :func:`~strata.operators.scd.close_stale_versions`); the last one without an end is current.

A confirming row opens no version, yet it matters when a late row arrives between it and
its version: the values then change and change back. :func:`scd2_splice` therefore returns these rows beside the versions
(:data:`ROW_KIND` tells them apart) and takes them again as ``seen``. Without them a late row's version ends where the
next known version starts.

One shuffle by key and one sort feed all window functions; they keep running state only (offsets,
``lead`` ignoring nulls), so a long history is streamed, never held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType

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
from strata.operators.scd import _align, _common_type
from strata.schemas import SCD2_COLUMNS

#: Column of :func:`scd2_splice` that tells versions from rows that only confirm one.
ROW_KIND = "scd2_row"
#: Values of :data:`ROW_KIND`.
VERSION, SEEN = "version", "seen"

_KEY, _AT, _OPEN, _TIE, _VALUES, _AGE, _HASHED, _ROW = (
    "__strata_key", "__strata_at", "__strata_open", "__strata_tie", "__strata_values", "__strata_age", "__strata_hashed", "__strata_row"
)
#: Where the event comes from, in the order in which equal rows win.
_INCOMING, _CONFIRMED, _EXISTING = 0, 1, 2


class _Shape:
    """Columns, types and comparison of one merge."""

    def __init__(self, existing: DataFrame, incoming: DataFrame, key: str, order: str, tracked: Sequence[str] | None, compare: str) -> None:
        if compare not in ("hash", "struct"):
            raise ValueError("compare must be 'hash' or 'struct'")
        self.key, self.order, self.compare = key, order, compare
        self.tracked = list(TRACKED_COLUMNS if tracked is None else tracked)
        self.columns = existing.columns
        self.source = [c for c in self.columns if c not in SCD2_COLUMNS]
        spark = existing.sparkSession
        self.types = {c: _common_type(spark, existing.schema[c].dataType, incoming.schema[c].dataType) for c in self.source}
        at = _common_type(spark, existing.schema[EFFECTIVE_FROM].dataType, incoming.schema[order].dataType)
        self.types |= {EFFECTIVE_FROM: at, EFFECTIVE_TO: at, IS_CURRENT: BooleanType(), HASH_VERSION_COL: IntegerType()}

    def typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c).cast(self.types[c]).alias(c) for c in self.columns if c in rows.columns])

    def opened(self, rows: DataFrame, at: str, age: int) -> DataFrame:
        """Events of rows: the key shows the row's values from ``at`` on."""
        rows = self.typed(rows)
        values = change_hash(self.tracked) if self.compare == "hash" else F.struct(*self.tracked)
        hashed = F.col(HASH_VERSION_COL) if age == _EXISTING else F.lit(HASH_VERSION)
        return rows.select(
            F.col(self.key).alias(_KEY), F.col(at).cast(self.types[EFFECTIVE_FROM]).alias(_AT), F.lit(1).alias(_OPEN),
            row_digest(self.source).alias(_TIE), values.alias(_VALUES), F.lit(age).alias(_AGE), hashed.alias(_HASHED),
            F.struct(*self.source).alias(_ROW))

    def ended(self, rows: DataFrame, like: DataFrame) -> DataFrame:
        """Events of versions' ends: the key shows nothing unless a row opens at that time."""
        rows = self.typed(rows.where(F.col(EFFECTIVE_TO).isNotNull()))
        set_here = {_KEY: F.col(self.key), _AT: F.col(EFFECTIVE_TO), _OPEN: F.lit(0)}
        return rows.select(*[set_here.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])

    def by_time(self) -> str:
        return f"PARTITION BY {_KEY} ORDER BY {_AT} NULLS FIRST, {_OPEN}, {_TIE}, {_AGE}"


def _neighbour(expression: str, shape: _Shape, offset: str = "lead", nulls: str = "") -> Column:
    return F.expr(f"{offset}({expression}) {nulls} OVER ({shape.by_time()})")


def _chains(events: DataFrame, shape: _Shape) -> DataFrame:
    """Versions and confirming rows (:data:`ROW_KIND`) of the events of each key."""
    # one row per time: the last in the order of ties; an end only where nothing opens at that time
    last_at = ~_neighbour(_AT, shape).eqNullSafe(F.col(_AT)) | _neighbour(_OPEN, shape).isNull()
    rows = events.withColumn("__strata_last", last_at).where("__strata_last")
    same = _neighbour(_VALUES, shape, "lag").eqNullSafe(F.col(_VALUES)) & (_neighbour(_OPEN, shape, "lag") == 1)
    rows = rows.withColumn("__strata_bound", (F.col(_OPEN) == 0) | ~F.coalesce(same, F.lit(False)))
    rows = rows.withColumn(EFFECTIVE_TO, _neighbour(f"CASE WHEN __strata_bound THEN {_AT} END", shape, nulls="IGNORE NULLS"))
    head = F.col("__strata_bound")
    own = {
        EFFECTIVE_FROM: F.col(_AT),
        EFFECTIVE_TO: F.when(head, F.col(EFFECTIVE_TO)),
        IS_CURRENT: F.when(head, F.col(EFFECTIVE_TO).isNull()),
        HASH_VERSION_COL: F.col(_HASHED),
    }
    out = [own[c].cast(shape.types[c]).alias(c) if c in own else F.col(f"{_ROW}.{c}").alias(c) for c in shape.columns]
    return rows.where(F.col(_OPEN) == 1).select(*out, F.when(head, F.lit(VERSION)).otherwise(SEEN).alias(ROW_KIND))


def scd2_merge_versions(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = CUSTOMER_KEY,
    order: str = CUSTOMER_ORDER,
    tracked: Sequence[str] | None = None,
    *,
    compare: str = "hash",
    allow_missing_columns: bool = False,
) -> DataFrame:
    """The whole new dimension after a batch of which every row counts.

    A key's rows are put behind its current version in the order of ``order``; each change of the tracked values
    closes a version and opens the next at its time, so a key may gain several versions. Only
    the current slice is shuffled, with the batch; history passes through. Rows that are not newer than their
    key's current version are left out (:func:`strata.operators.quality.late_rows` shows the latest of them,
    :func:`scd2_splice` applies them); so are rows without a key or a time, which have no place in an order.
    """
    existing, incoming = _align(existing, incoming, allow_missing_columns)
    shape = _Shape(existing, incoming, key, order, tracked, compare)
    joins = F.coalesce(F.col(IS_CURRENT), F.lit(False)) & F.col(key).isNotNull()
    current = shape.opened(existing.where(joins), EFFECTIVE_FROM, _EXISTING)
    rows = incoming.select(*shape.source).where(F.col(key).isNotNull() & F.col(order).isNotNull())
    events = current.unionByName(shape.opened(rows, order, _INCOMING))
    known = F.max(F.when(F.col(_AGE) == _EXISTING, F.col(_AT))).over(Window.partitionBy(_KEY))
    late = (F.col(_AGE) == _INCOMING) & (F.col(_AT) <= F.col("__strata_known"))
    events = events.withColumn("__strata_known", known).where(~F.coalesce(late, F.lit(False)))
    merged = _chains(events, shape).where(F.col(ROW_KIND) == VERSION).drop(ROW_KIND)
    return shape.typed(existing.where(~joins)).unionByName(merged)


def scd2_splice(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = CUSTOMER_KEY,
    order: str = CUSTOMER_ORDER,
    tracked: Sequence[str] | None = None,
    *,
    seen: DataFrame | None = None,
    compare: str = "hash",
    allow_missing_columns: bool = False,
) -> DataFrame:
    """The new dimension and the rows that only confirm a version, told apart by :data:`ROW_KIND`.

    ``incoming`` may hold any number of rows per key, of any age. ``seen``: the confirming rows of earlier calls
    (:func:`seen_rows`); with them the result depends on the set of rows only, not on their order or batches.
    Keys that ``incoming`` does not name pass through, as do versions without a key or with a null current flag. Rows
    without a key or a time are left out (nothing says which history, or where in it, they belong to).
    At one time the row of the greatest digest holds; equal rows count once.

    Only touched keys are rebuilt: the rows of the dimension meet the batch's distinct keys in a semi-join,
    which Spark broadcasts if they are few.
    """
    existing, incoming = _align(existing, incoming, allow_missing_columns)
    shape = _Shape(existing, incoming, key, order, tracked, compare)
    rows = incoming.select(*shape.source).where(F.col(key).isNotNull() & F.col(order).isNotNull())
    touched = rows.select(F.col(key).alias(_KEY)).distinct()
    whole = F.col(IS_CURRENT).isNotNull() & F.col(key).isNotNull()
    in_batch = F.col(key) == F.col(_KEY)

    versions = existing.where(whole).join(touched, in_batch, "left_semi")
    opened = shape.opened(versions, EFFECTIVE_FROM, _EXISTING)
    events = opened.unionByName(shape.ended(versions, opened)).unionByName(shape.opened(rows, order, _INCOMING))
    passing = shape.typed(existing.where(whole).join(touched, in_batch, "left_anti")).unionByName(shape.typed(existing.where(~whole)))
    out = passing.withColumn(ROW_KIND, F.lit(VERSION))
    if seen is not None:
        confirmed = seen.join(touched, in_batch, "left_semi")
        events = events.unionByName(shape.opened(confirmed.select(*shape.source), order, _CONFIRMED))
        kept = shape.typed(seen.join(touched, in_batch, "left_anti").select(*shape.columns))
        out = out.unionByName(kept.withColumn(ROW_KIND, F.lit(SEEN)))
    return out.unionByName(_chains(events, shape))


def spliced_versions(rows: DataFrame) -> DataFrame:
    """The dimension in the result of :func:`scd2_splice`."""
    return rows.where(F.col(ROW_KIND) == VERSION).drop(ROW_KIND)


def seen_rows(rows: DataFrame) -> DataFrame:
    """The rows that only confirm a version in the result of :func:`scd2_splice` (the dimension's columns, without an interval's end)."""
    return rows.where(F.col(ROW_KIND) == SEEN).drop(ROW_KIND)
