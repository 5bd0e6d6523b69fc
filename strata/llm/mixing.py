"""Mixing sources to target weights, in DataFrame functions only.

A document's size is its number of words (runs without space or tab..CR; a null text
has none). Sources, ordered by code point with the null source last, weigh 3, 1, 2, 3, 1, 2, ...
and share ``SHARE`` of all words by weight. No target exceeds ``REPEATS`` times its source's
words; what is cut off is shared again by weight among the other sources. The end of that
process is ``target = min(REPEATS * words, weight * level)`` with one level for all sources,
found in closed form from running sums over the sources in the order of the level at which
each is full (one row per source, after a partial aggregation; documents are never ordered).

A source's rate is target / words. A document is taken floor(rate) times, and once more
if a hash of its id and text, spread over [0, 1), is below the fraction of the rate. Rows that
are equal get equal draws, and reruns agree.

Defined cases: documents without words are never taken by a positive target's rate alone: a
source without words has target 0 and rate 0; a null id hashes as empty text; with no rows
there is no output. Other columns are kept by :func:`mixed` and ignored by :func:`plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

WEIGHTS = (3, 1, 2)
#: Words of the mix as a fraction of all words (numerator, denominator), and most repeats of a source.
SHARE = (3, 2)
REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` of rows ``(source, size)``."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.lit(WEIGHTS[-1])
    for k, w in enumerate(WEIGHTS[:-1]):
        weight = F.when(F.col("place") == k, w).otherwise(weight)
    rows = total.withColumn("place", place).select("source", "source_size", weight.cast("long").alias("weight"))
    rows = rows.withColumn("full", F.col("source_size") * REPEATS)
    # sources full below a level, in the order of that level
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "source", "source_size", "weight", "full",
        F.coalesce(F.sum("full").over(below), F.lit(0)).alias("filled"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(below), F.lit(0))).alias("open_weight"),
        F.sum("source_size").over(whole).alias("all_size"),
        F.row_number().over(order).alias("k"),
    )
    # the level if this source and all after it are open: (share of all - filled) / open weight
    rest = F.col("all_size") * SHARE[0] - F.col("filled") * SHARE[1]
    fits = rest * F.col("weight") <= F.col("full") * F.col("open_weight") * SHARE[1]
    first = F.min(F.when(fits, F.struct("k", rest.alias("rest"), "open_weight"))).over(whole)
    rows = rows.withColumn("first", first)
    shared = F.col("weight") * F.col("first.rest") / (F.col("first.open_weight") * SHARE[1])
    target = F.when(F.col("first").isNull() | (F.col("k") < F.col("first.k")), F.col("full").cast("double")).otherwise(shared)
    return rows.select("source", "source_size", target.alias("target"))


def _draw() -> Column:
    """A hash of the document's id and text, spread over [0, 1)."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def _with_copies(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``rows`` (with their ``__mix_draw``) and their source's goal, with ``__mix_copies``.

    Goals have one row per source and are stored: Spark broadcasts them if they are small, and no row is shuffled.
    """
    rate = F.coalesce(F.try_divide(F.col("__mix_target"), F.col("__mix_source_size")), F.lit(0.0))
    copies = F.floor(rate) + F.when(F.col("__mix_draw") < rate - F.floor(rate), 1).otherwise(0)
    goals = stored(goals, "mixing-goals").toDF("__mix_source", "__mix_source_size", "__mix_target")
    return rows.join(goals, F.col("source").eqNullSafe(F.col("__mix_source"))).withColumn("__mix_copies", copies)


def plan(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` for every row of ``docs`` (copies: 0, 1, ...)."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _draw().alias("__mix_draw"))
    rows = stored(rows, "mixing-sizes")
    names = {"__mix_source_size": "source_size", "__mix_target": "target", "__mix_copies": "copies"}
    return _with_copies(rows, targets(rows)).drop("__mix_source", "__mix_draw").withColumnsRenamed(names)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: every document as often as it is taken, with the columns of ``docs`` (names that start with ``__mix_`` are the operator's)."""
    goals = targets(docs.select("source", n_words(F.col("text")).alias("size")))
    taken = _with_copies(docs.withColumn("__mix_draw", _draw()), goals).where("__mix_copies > 0")
    taken = taken.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
    return taken.drop("__mix_draw", "__mix_source", "__mix_source_size", "__mix_target", "__mix_copies", "__mix_copy")
