"""Reusable column expressions.

All of them are plain ``pyspark.sql.functions`` compositions: no UDF, so they
are evaluated inside whole-stage codegen next to the scan that feeds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import (
    GOLD_MIN,
    HASH_SEPARATOR,
    HASH_VERSION,
    NULL_TOKEN,
    PLATINUM_MIN,
    SILVER_MIN,
    TIER_LABELS,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first: str | Column = "first_name", last: str | Column = "last_name") -> Column:
    """``first last``; a null part is skipped, two nulls give ``""`` (never null)."""
    return F.concat_ws(" ", _col(first), _col(last))


def revenue_tier(
    revenue: str | Column = "revenue_ytd",
    bounds: Sequence[float] = (PLATINUM_MIN, GOLD_MIN, SILVER_MIN),
    labels: Sequence[str] = TIER_LABELS,
) -> Column:
    """Label of the first inclusive lower bound that ``revenue`` reaches.

    ``labels`` has one more entry than ``bounds``: the fallback, which also
    catches null revenue (a null comparison is never true). NaN sorts above
    every number in Spark, so NaN lands in the top tier.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("labels must have exactly one entry more than bounds")
    value = _col(revenue)
    expr = None
    for bound, label in zip(bounds, labels):
        cond = value >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(labels[-1]) if expr is None else expr.otherwise(F.lit(labels[-1]))


def null_safe_text(c: str | Column) -> Column:
    """String form of a value with nulls replaced by the null token.

    Without the token ``concat_ws`` would skip nulls, and ``("a", null, "b")``
    and ``("a", "b", null)`` would produce the same text.
    """
    return F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN))


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_text(literal: str) -> str:
    return "'" + literal.replace("\\", "\\\\").replace("'", "\\'") + "'"


def row_digest(
    columns: Sequence[str | Column], prefix: str | None = None, qualifier: str | None = None
) -> Column:
    """SHA-256 (hex) of the null-safe text of ``columns`` joined by the separator.

    Column names (optionally of an aliased join side, ``qualifier``) are built
    as one SQL expression -- one call into the JVM instead of several per
    column; Column arguments are composed with the function API.
    """
    if all(isinstance(c, str) for c in columns):
        side = f"{_quote(qualifier)}." if qualifier else ""
        parts = [_sql_text(prefix)] if prefix is not None else []
        parts += [f"coalesce(CAST({side}{_quote(c)} AS STRING), {_sql_text(NULL_TOKEN)})" for c in columns]
        return F.expr(f"sha2(concat_ws({_sql_text(HASH_SEPARATOR)}, {', '.join(parts)}), 256)")
    parts = [F.lit(prefix)] if prefix is not None else []
    parts += [null_safe_text(F.col(f"{qualifier}.{c}") if qualifier and isinstance(c, str) else c) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def change_hash(
    tracked: Sequence[str],
    qualifier: str | None = None,
    version: int = HASH_VERSION,
) -> Column:
    """Versioned change hash of the tracked attributes.

    ``qualifier`` selects a side of an aliased join (``"n"`` -> ``n.col``).
    The version goes first, so hashes made under different layouts differ.
    """
    return row_digest(list(tracked), prefix=str(version), qualifier=qualifier)
