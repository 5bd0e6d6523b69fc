"""Property tests: column expressions against a plain-Python model on generated values."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata.constants import GOLD_MIN, PLATINUM_MIN, SILVER_MIN, TIER_LABELS
from strata.functions.columns import full_name, revenue_tier

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_tier(v):
    if v is None:
        return TIER_LABELS[-1]
    if math.isnan(v):  # NaN sorts above every number in Spark
        return TIER_LABELS[0]
    for bound, label in zip((PLATINUM_MIN, GOLD_MIN, SILVER_MIN), TIER_LABELS):
        if v >= bound:
            return label
    return TIER_LABELS[-1]


def model_name(first, last):
    return " ".join(p for p in (first, last) if p is not None)


revenues = st.one_of(
    st.none(),
    st.floats(allow_nan=True, allow_infinity=True),
    st.sampled_from([PLATINUM_MIN, GOLD_MIN, SILVER_MIN]).flatmap(
        lambda b: st.sampled_from([b - 0.01, float(b), b + 0.01])
    ),
)


@SETTINGS
@given(st.lists(revenues, min_size=1, max_size=40))
def test_revenue_tier_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], StructType([StructField("r", DoubleType())]))
    got = [r.t for r in df.select(revenue_tier("r").alias("t")).collect()]
    assert got == [model_tier(v) for v in values]


names = st.one_of(st.none(), st.text(max_size=8))


@SETTINGS
@given(st.lists(st.tuples(names, names), min_size=1, max_size=40))
def test_full_name_matches_model(spark, pairs):
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    df = spark.createDataFrame(pairs, schema)
    got = [r.n for r in df.select(full_name("a", "b").alias("n")).collect()]
    assert got == [model_name(a, b) for a, b in pairs]
