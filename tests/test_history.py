"""Histories of rows in any order, point-in-time lookup and aggregates over time, against plain Python."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import asof
from strata.operators.asof import as_of_join
from strata.operators.dedupe import latest_per_key
from strata.operators.history import ROW_KIND, scd2_merge_versions, scd2_splice, seen_rows, spliced_versions
from strata.operators.scd import SchemaMismatchError, empty_dimension, scd2_merge
from strata.operators.temporal import daily, over_time
from tests.fixtures import plan_text

SRC = "k string, note string, v string, at timestamp_ntz"
DIM = SRC + ", effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, hash_version int"
DAY = datetime(2031, 5, 1)


def _at(n):
    return None if n is None else DAY + timedelta(hours=n)


def _df(spark, rows, schema=SRC):
    return spark.createDataFrame([(k, note, v, _at(n)) for k, note, v, n in rows], schema)


def _digest(spark, rows):
    from strata.functions.columns import row_digest

    if not rows:
        return {}
    df = _df(spark, rows)
    return {(r.k, r.note, r.v, r.at): r.d for r in df.select("*", row_digest(df.columns).alias("d")).collect()}


def _plain_history(spark, rows):
    """Islands of equal ``v`` among a key's rows, one row per time (that of the greatest digest)."""
    digest = _digest(spark, rows)
    once: dict = {}
    for k, note, v, n in rows:
        row = (k, note, v, _at(n))
        if k is not None and n is not None and ((k, n) not in once or digest[row] > digest[once[k, n]]):
            once[k, n] = row
    keys = defaultdict(list)
    for (k, _), row in sorted(once.items()):
        if not keys[k] or keys[k][-1][2] != row[2]:
            keys[k].append(row)
    out = []
    for versions in keys.values():
        for row, after in zip(versions, [*versions[1:], None], strict=True):
            out.append((*row, row[3], after[3] if after else None, after is None, 1))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


KW = {"key": "k", "order": "at", "tracked": ["v"]}


def _splice_all(spark, batches, **kw):
    state, seen = empty_dimension(_df(spark, []), "at"), None
    for batch in batches:
        rows = scd2_splice(state, _df(spark, batch), seen=seen, **KW, **kw)
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        state, seen = spliced_versions(rows), seen_rows(rows)
    return state


def test_splice_does_not_depend_on_the_order_of_arrival(spark):
    rng = random.Random(11)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.choice(["p", "q", None]), rng.randrange(14)) for _ in range(40)]
    batches = [rows[:9], rows[9:24], rows[24:]]
    want = _plain_history(spark, rows)
    for order in itertools.permutations(batches):
        assert _got(_splice_all(spark, order)) == want
    assert _got(_splice_all(spark, [rows], compare="struct")) == want


def test_a_late_row_between_a_version_and_its_confirmation_splits_it(spark):
    batches = [[("a", "", "p", 1)], [("a", "", "p", 9)], [("a", "", "q", 5)]]
    got = [(r.v, r.effective_from, r.effective_to, r.is_current) for r in _splice_all(spark, batches).orderBy("effective_from").collect()]
    assert got == [("p", _at(1), _at(5), False), ("q", _at(5), _at(9), False), ("p", _at(9), None, True)]


def test_splice_in_order_equals_the_merges(spark):
    batches = [
        [("a", "", "p", 1), ("b", "", "p", 2), ("c", "", "p", 3)],
        [("a", "", "q", 4), ("b", "n", "p", 5)],
        [("a", "", "p", 6), ("d", "", "z", 6), ("c", "", "w", 7)],
    ]
    state = empty_dimension(_df(spark, []), "at")
    for batch in batches:
        state = scd2_merge(state, _df(spark, batch), **KW)
    assert _got(state) == _got(_splice_all(spark, batches)) == _got(_splice_all(spark, batches[::-1]))


def test_splice_keeps_gaps_untouched_keys_and_rows_outside_any_order(spark):
    dim = spark.createDataFrame(
        [
            ("a", "", "p", _at(1), _at(1), _at(4), False, 1),  # closed without a successor
            ("a", "", "q", _at(8), _at(8), None, True, None),
            ("z", "", "p", _at(2), _at(2), _at(1), False, 1),  # another key, left as it is
            (None, "", "p", _at(1), _at(1), None, True, 1),
            ("a", "", "odd", _at(1), _at(1), None, None, 1),
        ],
        DIM,
    )
    late = _df(spark, [("a", "", "p", 2), ("a", "", "p", 6), (None, "", "x", 3), ("a", "", "x", None)])
    rows = scd2_splice(dim, late, **KW)
    got = {(r.v, r.effective_from): r for r in spliced_versions(rows).where("k = 'a' and is_current is not null").collect()}
    assert got["p", _at(1)].effective_to == _at(4)  # not extended over the gap
    assert (got["p", _at(6)].effective_to, got["p", _at(6)].is_current) == (_at(8), False)
    assert got["q", _at(8)].is_current and got["q", _at(8)].hash_version is None and len(got) == 3
    assert [(r.v, r.at) for r in seen_rows(rows).collect()] == [("p", _at(2))]
    others = spliced_versions(rows).where("k is null or k = 'z' or is_current is null")
    assert _got(others) == _got(dim.where("k is null or k = 'z' or is_current is null"))


def test_splice_repairs_an_interval_that_ends_before_it_starts(spark):
    dim = scd2_merge(empty_dimension(_df(spark, []), "at"), _df(spark, [("a", "", "c", 9)]), **KW)
    dim = scd2_merge(dim, _df(spark, [("a", "", "p", 1)]), **KW)  # late data applied: [9, 1) and [1, )
    rows = spliced_versions(scd2_splice(dim, _df(spark, [("a", "", "b", 5)]), **KW)).orderBy("effective_from").collect()
    assert [(r.v, r.effective_from, r.effective_to) for r in rows] == [("p", _at(1), _at(5)), ("b", _at(5), _at(9)), ("c", _at(9), None)]


def test_splice_of_other_columns_raises_or_pads(spark):
    dim = empty_dimension(_df(spark, []), "at")
    more = _df(spark, [("a", "", "p", 1)]).withColumn("extra", F.lit(3))
    with pytest.raises(SchemaMismatchError):
        scd2_splice(dim, more, **KW)
    assert "extra" in scd2_splice(dim, more, **KW, allow_missing_columns=True).columns
    with pytest.raises(ValueError):
        scd2_splice(dim, _df(spark, []), **KW, compare="text")
    assert scd2_splice(dim, _df(spark, []), **KW).columns == [*dim.columns, ROW_KIND]


def test_all_versions_of_batches_equal_the_plain_history(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abcd"), rng.choice("xy"), rng.choice(["p", "q", None]), n) for n in range(30) for _ in range(rng.randint(0, 3))]
    cut = [r for r in rows if r[3] < 12], [r for r in rows if 12 <= r[3] < 20], [r for r in rows if r[3] >= 20]
    for compare in ("hash", "struct"):
        state = empty_dimension(_df(spark, []), "at")
        for batch in cut:
            state = scd2_merge_versions(state, _df(spark, batch).repartition(3), **KW, compare=compare)
            state = spark.createDataFrame(state.collect(), state.schema)
        assert _got(state) == _plain_history(spark, rows)


def test_all_versions_leave_out_rows_that_are_not_newer(spark):
    state = scd2_merge_versions(empty_dimension(_df(spark, []), "at"), _df(spark, [("a", "", "p", 5), (None, "", "p", 5)]), **KW)
    out = scd2_merge_versions(state, _df(spark, [("a", "", "x", 5), ("a", "", "y", 2), ("a", "", "q", 7), ("b", "", "q", None)]), **KW)
    assert [(r.v, r.effective_from, r.effective_to) for r in out.orderBy("effective_from").collect()] == [("p", _at(5), _at(7)), ("q", _at(7), None)]


def test_all_versions_shuffle_the_current_slice_and_the_batch_once(spark):
    dim = spark.createDataFrame([("a", "", "p", _at(1), _at(1), None, True, 1)], DIM)
    plan = plan_text(scd2_merge_versions(dim, _df(spark, [("a", "", "q", 2)]), **KW), "simple")
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_latest_row_per_snapshot_in_any_order(spark):
    """What the registered query does, on rows with repeats across snapshots."""
    rng = random.Random(2)
    rows = [(rng.choice("abcdef"), "", rng.choice("pqr"), n) for n in range(60)]
    snaps = [_df(spark, rows[:20]), _df(spark, rows[:40]), _df(spark, rows[40:])]  # the second repeats the first
    state = empty_dimension(snaps[0], "at")
    for s in snaps:
        state = scd2_merge(state, s, **KW)
    spliced, seen = empty_dimension(snaps[0], "at"), None
    for s in (snaps[2], snaps[0], snaps[1]):
        rows_ = scd2_splice(spliced, latest_per_key(s, "k", "at"), seen=seen, **KW)
        rows_ = spark.createDataFrame(rows_.collect(), rows_.schema)
        spliced, seen = spliced_versions(rows_), seen_rows(rows_)
    assert _got(spliced) == _got(state)


# ---- point in time -----------------------------------------------------------


def _dimension(spark, rng, keys="abch", per_key=25):
    rows = []
    for k in keys:
        times = sorted(rng.sample(range(200), per_key))
        for a, b in zip(times, [*times[1:], None], strict=True):
            end = b if b is None or rng.random() < 0.8 else a + max(0, (b - a) // 2)  # some gaps
            rows.append((k, "", f"{k}{a}", _at(a), _at(a), _at(end), end is None, 1))
    rows += [(None, "", "none", _at(1), _at(1), None, True, 1), ("e", "", "first", None, None, _at(50), False, 1),
             ("e", "", "inverted", _at(60), _at(60), _at(30), False, 1), ("e", "", "empty", _at(70), _at(70), _at(70), False, 1)]
    return rows, spark.createDataFrame(rows, DIM)


def _valid_then(dim, k, n):
    if k is None or n is None:
        return None
    t = _at(n)
    found = [r for r in dim if r[0] == k and (r[4] is None or r[4] <= t) and (r[5] is None or t < r[5])]
    return max(found, key=lambda r: r[4] or datetime.min)[2] if found else None


@pytest.mark.parametrize("hot_rows", [None, 7, 60, 10**6])
def test_as_of_join_equals_plain_lookup(spark, hot_rows):
    rng = random.Random(13)
    rows, dim = _dimension(spark, rng)
    facts = [(i, rng.choice(["h"] * 8 + ["a", "b", "c", "e", "unknown", None]), rng.choice([None, *range(210)]), "note") for i in range(500)]
    facts += facts[:20]
    df = spark.createDataFrame([(i, k, _at(n), s) for i, k, n, s in facts], "id long, who string, moment timestamp_ntz, note string").repartition(5)
    got = as_of_join(df, dim, "who", "moment", ["v", "effective_from"], key="k", hot_rows=hot_rows)
    assert got.columns == ["id", "who", "moment", "note", "v", "effective_from"]
    assert sorted((r.id, r.v or "") for r in got.collect()) == sorted((i, _valid_then(rows, k, n) or "") for i, k, n, _ in facts)
    plan = plan_text(got, "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_hot_key_is_cut_into_bins(spark):
    rng = random.Random(3)
    _, dim = _dimension(spark, rng, keys="h", per_key=40)
    df = spark.createDataFrame([("h", _at(rng.randrange(200))) for _ in range(960)], "who string, moment timestamp_ntz")
    events = df.select(F.col("who").alias(asof._KEY), F.col("moment").alias(asof._AT), F.struct("who").alias(asof._FACT)).unionByName(
        dim.where("k = 'h'").select(F.col("k").alias(asof._KEY), F.col("effective_from").alias(asof._AT), F.struct("v", "effective_to").alias(asof._VERSION)),
        allowMissingColumns=True)
    size = {r[asof._BIN]: r["count"] for r in asof._binned(events, 100).groupBy(asof._BIN).count().collect()}
    assert len(size) >= 8 and max(size.values()) < 200


def test_as_of_join_on_nothing_and_on_clashing_names(spark):
    _, dim = _dimension(spark, random.Random(1))
    facts = spark.createDataFrame([("a", _at(3))], "who string, v timestamp_ntz")
    with pytest.raises(ValueError):
        as_of_join(facts, dim, "who", "v", ["v"], key="k")
    assert as_of_join(facts.limit(0), dim, "who", "v", ["note"], key="k").collect() == []
    assert [r.note for r in as_of_join(facts, dim.limit(0), "who", "v", ["note"], key="k").collect()] == [None]


# ---- over time ----------------------------------------------------------------


def _amounts(spark):
    rng = random.Random(21)
    rows = []
    for _ in range(150):
        a = rng.randrange(400)
        b = rng.choice([None, a + rng.randrange(1, 90), a, a - 3])
        rows.append((rng.choice(["x", "x", "y", None]), rng.choice([None, 0.1, 10.25, -3.0]), _at(a) if rng.random() < 0.95 else None, _at(b)))
    return rows, spark.createDataFrame(rows, "g string, revenue_ytd double, effective_from timestamp_ntz, effective_to timestamp_ntz")


def _sum_then(rows, g, t):
    valid = [r for r in rows if r[0] == g and r[2] is not None and r[2] <= t and (r[3] is None or (t < r[3] and r[2] < r[3]))]
    return len(valid), sum((Decimal(str(r[1])) for r in valid if r[1] is not None), Decimal(0))


@pytest.mark.parametrize("period", ["day", "month"])
def test_over_time_equals_the_versions_valid_at_each_change(spark, period):
    rows, df = _amounts(spark)
    got = over_time(df.repartition(4), ["g"], period=period).collect()
    times = defaultdict(set)
    for g, _, a, b in rows:
        if a is not None and (b is None or b > a):
            times[g] |= {a, b} - {None}
    assert {(r.g, r.at) for r in got} == {(g, t) for g, ts in times.items() for t in ts} and len(got) == sum(map(len, times.values()))
    for r in got:
        later = [t for t in times[r.g] if t > r.at]
        assert r.until == (min(later) if later else None)
        assert (r.row_count, r.total) == _sum_then(rows, r.g, r.at)


def test_daily_states_are_those_at_midnight(spark):
    rows, df = _amounts(spark)
    states = over_time(df, ["g"])
    got = {(r.g, r.day): (r.row_count, r.total) for r in daily(states).collect()}
    first = {r.g: r.f for r in states.groupBy("g").agg(F.min("at").alias("f")).collect()}
    last = max(r.at for r in states.collect()).date()
    want = {}
    for g, start in first.items():
        day = start.date() if start == datetime.combine(start.date(), datetime.min.time()) else start.date() + timedelta(days=1)
        while day <= last:
            want[g, day] = _sum_then(rows, g, datetime.combine(day, datetime.min.time()))
            day += timedelta(days=1)
    assert got == want
    assert max(r.day for r in daily(states, "2031-05-04").collect()) == date(2031, 5, 4)


def test_over_time_of_nothing_and_of_reserved_names(spark):
    _, df = _amounts(spark)
    assert over_time(df.limit(0), ["g"]).collect() == [] and daily(over_time(df.limit(0), ["g"])).collect() == []
    with pytest.raises(ValueError):
        over_time(df.withColumnRenamed("g", "at"), ["at"])
