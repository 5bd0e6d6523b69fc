"""Sums of doubles that do not depend on the order or partitioning of the rows.

Adding doubles rounds after each step, so the last bits of a sum depend on the order. Here each amount counts as the
decimal that it prints as (rounded to 18 places), split into its whole part and its fraction; both are summed as
decimals, exactly. The sums are a state that can be stored and merged (:func:`merged`); :func:`total`
rounds once, at the end. Amounts of 1e37 and more count as infinite. NaN, or infinities of both signs, make the total
NaN; infinities of one sign make it infinite. Nulls count nowhere, and a total of no amounts is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on doubles are whole numbers, and amounts count as infinite.
_WHOLE, _INFINITE = 1e19, 1e37
_PARTS = ("amounts", "whole", "part", "nan", "plus", "minus")


def sums(amount: str | Column, prefix: str = "sum") -> list[Column]:
    """The aggregate columns of the state, for ``groupBy(...).agg(*sums(...))``."""
    value = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    size = F.abs(value)
    small = F.when(size < _WHOLE, value.try_cast("decimal(38,18)"))  # NaN is the largest double
    part = small % 1  # decimal(19,18), with the amount's sign
    cut = F.when(small < 0, F.ceil(small)).otherwise(F.floor(small)).cast("decimal(38,0)")
    whole = F.coalesce(cut, F.when((size >= _WHOLE) & (size < _INFINITE), value.try_cast("decimal(38,0)")))
    infinite = ~F.isnan(value) & (size >= _INFINITE)
    state = [
        F.count(value),
        F.coalesce(F.sum(whole).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")),
        F.coalesce(F.sum(part).cast("decimal(38,18)"), F.lit(0).cast("decimal(38,18)")),
        F.count(F.when(F.isnan(value), 1)),
        F.count(F.when(infinite & (value > 0), 1)),
        F.count(F.when(infinite & (value < 0), 1)),
    ]
    return [column.alias(f"{prefix}_{name}") for column, name in zip(state, _PARTS, strict=True)]


def merged(prefix: str = "sum") -> list[Column]:
    """The aggregate columns that add up states of the same prefix."""
    kinds = {"whole": "decimal(38,0)", "part": "decimal(38,18)"}
    return [F.sum(f"{prefix}_{name}").cast(kinds.get(name, "bigint")).alias(f"{prefix}_{name}") for name in _PARTS]


def total(prefix: str = "sum") -> Column:
    """The sum that a state stands for, as a double."""
    amounts, whole, part, nan, plus, minus = (F.col(f"{prefix}_{name}") for name in _PARTS)
    # exact where the whole part leaves room for 18 places, else the fractions are far below the last bit
    exact = whole.try_cast("decimal(19,0)") + part.try_cast("decimal(30,18)")
    finite = F.coalesce(exact.cast("double"), whole.cast("double") + part.cast("double"))
    infinite = F.when(plus > 0, float("inf")).otherwise(float("-inf"))
    return (
        F.when(amounts == 0, F.lit(None).cast("double"))
        .when((nan > 0) | ((plus > 0) & (minus > 0)), float("nan"))
        .when(plus + minus > 0, infinite)
        .otherwise(finite)
    )
