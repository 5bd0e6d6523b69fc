"""The type 2 merge in steps on one joined frame.

For flows that need to see or change what happens between the steps; :func:`strata.operators.scd.scd2_merge`
does the same in one pass. The joined frame holds the two sides as struct columns ``new`` and
``old``, so its fields are reached as ``new.<column>`` and ``old.<column>``, and the frame can be filtered,
written and read back, or shared by the steps that follow (each step is a projection of it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.constants import CUSTOMER_KEY, CUSTOMER_ORDER, EFFECTIVE_FROM, EFFECTIVE_TO, HASH_VERSION, HASH_VERSION_COL, IS_CURRENT
from strata.functions.columns import change_hash

NEW_SIDE, OLD_SIDE = "new", "old"


def _fields(frame: DataFrame, side: str) -> list[str]:
    return frame.schema[side].dataType.fieldNames()


def _all_fields(frame: DataFrame, side: str, replaced: dict[str, Column]) -> list[Column]:
    return [replaced.get(c, F.col(f"{side}.`{c}`")).alias(c) for c in _fields(frame, side)]


def join_incoming_with_current(latest_incoming: DataFrame, current_active: DataFrame, key: str = CUSTOMER_KEY) -> DataFrame:
    """One row per incoming row: ``new`` with the current row of its key as ``old`` (null if there is none)."""
    new = latest_incoming.select(F.struct(*latest_incoming.columns).alias(NEW_SIDE))
    old = current_active.select(F.struct(*current_active.columns).alias(OLD_SIDE))
    return new.join(old, F.col(f"{NEW_SIDE}.{key}") == F.col(f"{OLD_SIDE}.{key}"), "left")


def detect_changed_or_new(joined: DataFrame, tracked_cols: Sequence[str]) -> DataFrame:
    """The joined rows without an old side, or whose tracked values differ (by change hash)."""
    differs = change_hash(tracked_cols, NEW_SIDE) != change_hash(tracked_cols, OLD_SIDE)
    return joined.where(F.col(OLD_SIDE).isNull() | differs)


def build_closed_rows(changed_or_new: DataFrame, order: str = CUSTOMER_ORDER) -> DataFrame:
    """The old rows that end: ``effective_to`` is the new row's time, ``is_current`` false."""
    types = {f.name: f.dataType for f in changed_or_new.schema[OLD_SIDE].dataType.fields}
    ended = {EFFECTIVE_TO: F.col(f"{NEW_SIDE}.{order}").cast(types[EFFECTIVE_TO]), IS_CURRENT: F.lit(False)}
    return changed_or_new.where(F.col(OLD_SIDE).isNotNull()).select(_all_fields(changed_or_new, OLD_SIDE, ended))


def build_inserted_rows(changed_or_new: DataFrame, order: str = CUSTOMER_ORDER) -> DataFrame:
    """The new rows as current versions that start at their own time."""
    start = F.col(f"{NEW_SIDE}.{order}")
    end_type = changed_or_new.schema[OLD_SIDE].dataType[EFFECTIVE_TO].dataType
    return changed_or_new.select(
        *_all_fields(changed_or_new, NEW_SIDE, {}), start.alias(EFFECTIVE_FROM), F.lit(None).cast(end_type).alias(EFFECTIVE_TO),
        F.lit(True).alias(IS_CURRENT), F.lit(HASH_VERSION).alias(HASH_VERSION_COL))


def get_unchanged_current_rows(current_active: DataFrame, changed_or_new: DataFrame, key: str = CUSTOMER_KEY) -> DataFrame:
    """The current rows whose key has no changed row (also those whose key is null or not in the snapshot)."""
    changed = changed_or_new.select(F.col(f"{NEW_SIDE}.{key}").alias("__strata_changed"))
    return current_active.join(changed, F.col(key) == F.col("__strata_changed"), "left_anti")
