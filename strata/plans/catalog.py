"""Catalog of the library's queries over the driver tables.

Each entry pairs a Spark query ``(spark, sf_dir) -> DataFrame`` with the SQL
text of an independent oracle formulation (see :mod:`strata.plans.oracle`).
Every query reads whole tables: snapshots that meet in one query hold all orders
between them. Computed columns carry the same alias on
both sides. Chained merges cut lineage between states with ``checkpoint()`` in the
session's checkpoint folder, so each state is computed once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import TRACKED_COLUMNS
from strata.functions.columns import change_hash
from strata.operators.aggregates import (
    revenue_by_country,
    revenue_by_segment,
    revenue_levels,
    user_count_by_country,
)
from strata.operators.asof import as_of_join
from strata.operators.dedupe import latest_by_aggregate, latest_per_key
from strata.operators.history import scd2_merge_versions, scd2_splice, seen_rows, spliced_versions
from strata.operators.quality import (
    dimension_report,
    duplicate_current,
    duplicate_keys,
    interval_violations,
    key_uniqueness,
    late_rows,
    null_keys,
)
from strata.operators.rows import (
    filter_valid_customers,
    keep_active,
    silver_customers,
    silver_users,
    with_revenue_tier,
)
from strata.operators.scd import (
    CHANGE,
    close_stale_versions,
    current_rows,
    empty_dimension,
    history_rows,
    scd1,
    scd1_merge,
    scd2_changes,
    scd2_merge,
    scd2_merge_keyless,
    stale_hash_rows,
)
from strata.operators.steps import (
    build_closed_rows,
    build_inserted_rows,
    detect_changed_or_new,
    get_unchanged_current_rows,
    join_incoming_with_current,
)
from strata.operators.temporal import daily, over_time
from strata.functions.stable import sums, total
from strata.plans import oracle as O
from strata.plans import round_trips
from strata.session import cut_lineage
from strata.sources.tables import EVERYTHING, SNAPSHOT_2_END, customer_states, snapshot, table, users

Query = Callable[[SparkSession, str], DataFrame]

# Close time used by the options that close rows without an incoming row.
CLOSE_AT = SNAPSHOT_2_END


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------------------
# Spark side: building blocks
# ---------------------------------------------------------------------------


def _silver_snapshot(spark: SparkSession, d: str, n: int) -> DataFrame:
    return silver_customers(snapshot(spark, d, n))


def _first_load(spark: SparkSession, d: str, n: int = 1, validated: bool = True) -> DataFrame:
    snap = _silver_snapshot(spark, d, n) if validated else snapshot(spark, d, n)
    return cut_lineage(scd2_merge(empty_dimension(snap), snap))


def _two_states(spark: SparkSession, d: str, **opts) -> DataFrame:
    return scd2_merge(_first_load(spark, d), _silver_snapshot(spark, d, EVERYTHING), **opts)


def _state2(spark: SparkSession, d: str) -> DataFrame:
    return cut_lineage(scd2_merge(_first_load(spark, d), _silver_snapshot(spark, d, 2)))


def _state3(spark: SparkSession, d: str) -> DataFrame:
    return scd2_merge(_state2(spark, d), _silver_snapshot(spark, d, 3))


def _changes2(spark: SparkSession, d: str) -> DataFrame:
    return scd2_changes(_first_load(spark, d), _silver_snapshot(spark, d, EVERYTHING))


def _changes3(spark: SparkSession, d: str) -> DataFrame:
    return scd2_changes(_state2(spark, d), _silver_snapshot(spark, d, 3))


def _kind(df: DataFrame, *kinds: str) -> DataFrame:
    return df.filter(F.col(CHANGE).isin(*kinds)).drop(CHANGE)


def _out_of_order(spark: SparkSession, d: str, **opts) -> DataFrame:
    """Snapshot 3 loaded first, then the older snapshot 2 arrives."""
    return scd2_merge(_first_load(spark, d, 3), _silver_snapshot(spark, d, 2), **opts)


def _legacy(spark: SparkSession, d: str, n: int = EVERYTHING) -> DataFrame:
    """A dimension written before ``hash_version`` existed, merged with a later snapshot."""
    return scd2_merge(_first_load(spark, d).drop("hash_version"), _silver_snapshot(spark, d, n))


def _both_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots 2 and 3 loaded on their own and put together, so many keys have two current rows."""
    return _first_load(spark, d, 2).unionByName(_first_load(spark, d, 3))


def _spliced(spark: SparkSession, d: str) -> DataFrame:
    """The three snapshots arrive as 3, 1, 2."""
    state = seen = None
    for n in (3, 1, 2):
        snap = latest_per_key(_silver_snapshot(spark, d, n), "customer_id", "updated_at")
        rows = cut_lineage(scd2_splice(empty_dimension(snap) if state is None else state, snap, seen=seen))
        state, seen = spliced_versions(rows), seen_rows(rows)
    return state


def _all_versions(spark: SparkSession, d: str) -> DataFrame:
    """Every row of silver as it was, in two batches."""
    first = _silver_snapshot(spark, d, 2)
    state = cut_lineage(scd2_merge_versions(empty_dimension(first), first))
    return scd2_merge_versions(state, _silver_snapshot(spark, d, 3))


def _orders_as_of(spark: SparkSession, d: str) -> DataFrame:
    """All orders with what the dimension said of their customer at the order date."""
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_customer"), "o_orderdate")
    dim = cut_lineage(_all_versions(spark, d))
    return as_of_join(orders, dim, "o_customer", "o_orderdate", ["revenue_tier", "revenue_ytd", "city", "effective_from"])


def _revenue_over_time(spark: SparkSession, d: str) -> DataFrame:
    return over_time(cut_lineage(_all_versions(spark, d)), ["country"])


def _joined_steps(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The current rows of the first load, and their join with the latest rows of everything."""
    current = current_rows(_first_load(spark, d))
    latest = latest_per_key(_silver_snapshot(spark, d, EVERYTHING), "customer_id", "updated_at")
    return current, join_incoming_with_current(latest, current)


def _changed_or_new(spark: SparkSession, d: str) -> DataFrame:
    _, joined = _joined_steps(spark, d)
    changed = detect_changed_or_new(joined, TRACKED_COLUMNS)
    return changed.select("new.*", F.col("old.effective_from").alias("old_effective_from"))


def _by_steps(spark: SparkSession, d: str) -> DataFrame:
    """The merge of :func:`_two_states`, step by step on one joined frame."""
    current, joined = _joined_steps(spark, d)
    changed = cut_lineage(detect_changed_or_new(joined, TRACKED_COLUMNS))
    kept = get_unchanged_current_rows(current, changed)
    return build_closed_rows(changed).unionByName(build_inserted_rows(changed)).unionByName(kept)


def _carried_forward(spark: SparkSession, d: str) -> DataFrame:
    current, joined = _joined_steps(spark, d)
    return get_unchanged_current_rows(current, detect_changed_or_new(joined, TRACKED_COLUMNS))


def _keyless(spark: SparkSession, d: str) -> DataFrame:
    """Unvalidated snapshots with rows without a key; the last snapshot arrives twice."""
    state = empty_dimension(snapshot(spark, d, 1))
    for n in (1, EVERYTHING, EVERYTHING):
        state = cut_lineage(scd2_merge_keyless(state, snapshot(spark, d, n)))
    return state


def _stable_by_segment(spark: SparkSession, d: str) -> DataFrame:
    """Revenue by country and tier as the doubles add up exactly, unrounded."""
    state = _all_silver(spark, d).groupBy("country", "revenue_tier").agg(F.count(F.lit(1)).alias("customer_count"), *sums("revenue_ytd"))
    return state.select("country", "revenue_tier", "customer_count", total().alias("total_revenue"))


def _all_silver(spark: SparkSession, d: str) -> DataFrame:
    return silver_customers(customer_states(spark, d))


SPARK: dict[str, Query] = {
    # user flow
    "active_users_full_name": lambda s, d: silver_users(users(s, d)),
    "user_count_by_country": lambda s, d: user_count_by_country(silver_users(users(s, d))),
    # customer silver
    "valid_active_customers": lambda s, d: keep_active(filter_valid_customers(customer_states(s, d))),
    "customers_with_tier": lambda s, d: with_revenue_tier(customer_states(s, d)),
    "silver_valid_customers": _all_silver,
    # gold
    "revenue_by_country": lambda s, d: revenue_by_country(_all_silver(s, d)),
    "revenue_by_country_exact": lambda s, d: revenue_by_country(_all_silver(s, d), exact=True),
    "revenue_by_segment": lambda s, d: revenue_by_segment(_all_silver(s, d), round_to=2),
    # the unrounded double average of a small group can sit on a half cent, where
    # engines round differently; the average is compared in revenue_by_country
    "revenue_levels": lambda s, d: revenue_levels(_all_silver(s, d)).select(
        "country",
        "revenue_tier",
        "level",
        "customer_count",
        F.round("revenue_sum", 2).alias("revenue_sum"),
    ),
    "revenue_by_segment_stable": _stable_by_segment,
    "revenue_by_segment_exact": lambda s, d: revenue_by_segment(_all_silver(s, d), exact=True),
    # dedup / type 1
    "latest_per_customer": lambda s, d: latest_per_key(customer_states(s, d), "customer_id", "updated_at"),
    "latest_by_aggregate": lambda s, d: latest_by_aggregate(customer_states(s, d), "customer_id", "updated_at"),
    "scd1_customers": lambda s, d: scd1(_all_silver(s, d)),
    # snapshots 2 (< 1999) and 3 (>= 1999) together hold every row once
    "scd1_incremental": lambda s, d: scd1_merge(
        cut_lineage(scd1(_silver_snapshot(s, d, 2))), _silver_snapshot(s, d, 3)
    ),
    "change_hash": lambda s, d: _all_silver(s, d).select(
        "customer_id", "updated_at", change_hash(TRACKED_COLUMNS).alias("change_hash")
    ),
    # type 2
    "scd2_first_load": lambda s, d: _first_load(s, d, EVERYTHING),
    "scd2_merge": _two_states,
    "scd2_three_snapshots": _state3,
    "scd2_changes": _changes2,
    "scd2_final_changes": _changes3,
    "scd2_new": lambda s, d: _kind(_changes2(s, d), "new"),
    "scd2_inserted": lambda s, d: _kind(_changes2(s, d), "new", "changed"),
    "scd2_closed": lambda s, d: _kind(_changes2(s, d), "closed"),
    "scd2_unchanged": lambda s, d: _kind(_changes2(s, d), "unchanged"),
    "scd2_absent": lambda s, d: _kind(_changes3(s, d), "absent"),
    "scd2_current": lambda s, d: current_rows(_state3(s, d)),
    "scd2_history": lambda s, d: history_rows(_state3(s, d)),
    "scd2_unvalidated": lambda s, d: scd2_merge(
        _first_load(s, d, 1, validated=False), snapshot(s, d, EVERYTHING)
    ),
    "scd2_unvalidated_absent_close": lambda s, d: scd2_merge(
        _first_load(s, d, 2, validated=False), snapshot(s, d, 3), absent="close", close_absent_at=_ts(CLOSE_AT)
    ),
    "scd2_struct_compare": lambda s, d: _two_states(s, d, compare="struct"),
    "scd2_absent_close": lambda s, d: scd2_merge(
        _state2(s, d), _silver_snapshot(s, d, 3), absent="close", close_absent_at=_ts(CLOSE_AT)
    ),
    "scd2_out_of_order": _out_of_order,
    "scd2_late_ignored": lambda s, d: _out_of_order(s, d, late="ignore"),
    "scd2_legacy_backfill": _legacy,
    "stale_hash_rows": lambda s, d: stale_hash_rows(_legacy(s, d)),
    "scd2_after_stale_close": lambda s, d: scd2_merge(
        close_stale_versions(_legacy(s, d, 2), _ts(CLOSE_AT)), _silver_snapshot(s, d, 3)
    ),
    "scd2_changed_or_new": _changed_or_new,
    "scd2_by_steps": _by_steps,
    "scd2_carried_forward": _carried_forward,
    "scd2_keyless": _keyless,
    # files, jobs, store and catalog
    "users_csv_roundtrip": round_trips.users_csv,
    "users_csv_rejects": round_trips.users_csv_rejects,
    "user_job_gold": round_trips.user_job,
    "customers_parquet_roundtrip": round_trips.customers_parquet,
    "customer_job_scd2": round_trips.customer_job,
    "customer_batches_gold": round_trips.customer_batches_gold,
    "store_three_merges": round_trips.store_merges,
    "scd2_by_name": round_trips.named_dimension,
    "golds_by_changes": round_trips.golds_by_changes,
    # histories of rows in any order, lookups and aggregates over time
    "scd2_spliced": _spliced,
    "scd2_all_versions": _all_versions,
    "orders_as_of": _orders_as_of,
    "revenue_over_time": lambda s, d: _revenue_over_time(s, d).withColumn("total", F.col("total").cast("double")),
    "revenue_daily": lambda s, d: daily(cut_lineage(_revenue_over_time(s, d))).withColumn("total", F.col("total").cast("double")),
    # quality
    "duplicate_current": lambda s, d: duplicate_current(_state3(s, d)),
    "duplicate_current_found": lambda s, d: duplicate_current(_both_loaded(s, d)),
    "duplicate_snapshot_keys": lambda s, d: duplicate_keys(customer_states(s, d)),
    "key_uniqueness": lambda s, d: key_uniqueness(scd1(_all_silver(s, d))),
    "null_key_rows": lambda s, d: null_keys(customer_states(s, d)),
    "interval_violations": lambda s, d: interval_violations(_out_of_order(s, d)),
    "late_rows": lambda s, d: late_rows(_first_load(s, d, 3), _silver_snapshot(s, d, 2)),
    "dimension_report": lambda s, d: dimension_report(_out_of_order(s, d)),
}


# ---------------------------------------------------------------------------
# Oracle side
# ---------------------------------------------------------------------------

SRC, SILVER, SCD = O.SRC, O.SILVER, O.SCD
DIM = SILVER + SCD


def _sql_all_silver(q: O.Sql) -> str:
    return q.add("silver_all", O.silver(q.states()))


def _sql_first_load(q: O.Sql, n: int = 1, validated: bool = True, p: str = "m1") -> str:
    snap = q.snapshot(n, validated)
    names = SILVER if validated else SRC
    return q.merge(p, q.empty_dim(snap, names), snap, names)


def _sql_state2(q: O.Sql) -> str:
    return q.merge("m2", _sql_first_load(q), q.snapshot(2), SILVER)


def _sql_two_states(q: O.Sql, **opts) -> str:
    return q.merge("m2", _sql_first_load(q), q.snapshot(EVERYTHING), SILVER, **opts)


def _sql_state3(q: O.Sql) -> str:
    return q.merge("m3", _sql_state2(q), q.snapshot(3), SILVER)


def _sql_changes2(q: O.Sql) -> str:
    return q.changes("m2", _sql_first_load(q), q.snapshot(EVERYTHING), SILVER)


def _sql_changes3(q: O.Sql) -> str:
    return q.changes("m3", _sql_state2(q), q.snapshot(3), SILVER)


def _sql_out_of_order(q: O.Sql, **opts) -> str:
    first = _sql_first_load(q, 3, p="m1")
    return q.merge("late", first, q.snapshot(2), SILVER, **opts)


def _sql_legacy(q: O.Sql, n: int = EVERYTHING) -> str:
    first = _sql_first_load(q)
    legacy = q.add(
        "legacy", f"SELECT * EXCLUDE (hash_version), CAST(NULL AS INTEGER) AS hash_version FROM {first}"
    )
    return q.merge("m2", legacy, q.snapshot(n), SILVER)


def _sql_both_loaded(q: O.Sql) -> str:
    one, two = _sql_first_load(q, 2, p="m1"), _sql_first_load(q, 3, p="n1")
    return q.add("together", f"SELECT * FROM {one} UNION ALL SELECT * FROM {two}")


def _sql_close_stale(q: O.Sql) -> str:
    legacy = _sql_legacy(q, 2)
    stale = "is_current AND hash_version IS DISTINCT FROM 1"
    return q.add(
        "closed_stale",
        f"SELECT {O.cols(SILVER)}, effective_from, "
        f"CASE WHEN {stale} THEN TIMESTAMP '{CLOSE_AT}' ELSE effective_to END AS effective_to, "
        f"CASE WHEN {stale} THEN false ELSE is_current END AS is_current, hash_version FROM {legacy}",
    )


def _one(build: Callable[[O.Sql], str], final: Callable[[str], str] = lambda t: f"SELECT * FROM {t}"):
    def render() -> str:
        q = O.Sql()
        return q.render(final(build(q)))

    return render


def _changes_kind(build, *kinds: str):
    names = ", ".join(f"'{k}'" for k in kinds)
    return _one(
        build, lambda t: f"SELECT * EXCLUDE (scd2_change) FROM {t} WHERE scd2_change IN ({names})"
    )


def _dup_sql(t: str, where: str = "") -> str:
    return f"SELECT customer_id, count(*) AS cnt FROM {t} {where} GROUP BY customer_id HAVING count(*) > 1"


def _sql_late_rows(q: O.Sql) -> str:
    state = _sql_first_load(q, 3, p="m1")
    latest = q.add("late_l", O.latest(q.snapshot(2), SILVER))
    return q.add(
        "late",
        f"SELECT {O.cols(SILVER, 'l')}, c.effective_from AS current_effective_from "
        f"FROM {latest} l JOIN {state} c ON l.customer_id = c.customer_id "
        f"WHERE c.is_current AND l.updated_at <= c.effective_from",
    )


# Spark's decimal arithmetic in integer cents: the average is rounded HALF_UP to
# 6 decimals by the division, then HALF_UP to 2 (all amounts are positive)
_EXACT_BY_COUNTRY = """
SELECT country, customer_count, CAST(cents AS DOUBLE) / 100 AS total_revenue,
       CASE WHEN n > 0 THEN CAST(((cents * 20000 + n) // (2 * n) + 5000) // 10000 AS DOUBLE) / 100 END
         AS avg_revenue
FROM (
  SELECT country, count(*) AS customer_count, count(revenue_ytd) AS n,
         CAST(sum(CAST(revenue_ytd AS DECIMAL(18, 2))) * 100 AS HUGEINT) AS cents
  FROM {t} GROUP BY country
)
"""

_DIM_REPORT = """
SELECT CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows,
       CAST(coalesce(sum(current_rows), 0) AS BIGINT) AS current_rows,
       CAST(coalesce(sum(history_rows), 0) AS BIGINT) AS history_rows,
       CAST(coalesce(sum(null_is_current_rows), 0) AS BIGINT) AS null_is_current_rows,
       CAST(coalesce(sum(interval_violations), 0) AS BIGINT) AS interval_violations,
       CAST(coalesce(sum(open_history_rows), 0) AS BIGINT) AS open_history_rows,
       CAST(coalesce(sum(stale_hash_rows), 0) AS BIGINT) AS stale_hash_rows,
       CAST(coalesce(sum(CASE WHEN customer_id IS NULL THEN rows END), 0) AS BIGINT) AS null_key_rows,
       count(CASE WHEN current_rows > 1 THEN 1 END) AS duplicate_current_keys
FROM (
  SELECT customer_id, count(*) AS rows,
         count(CASE WHEN is_current THEN 1 END) AS current_rows,
         count(CASE WHEN NOT is_current THEN 1 END) AS history_rows,
         count(CASE WHEN is_current IS NULL THEN 1 END) AS null_is_current_rows,
         count(CASE WHEN effective_to < effective_from THEN 1 END) AS interval_violations,
         count(CASE WHEN (NOT is_current AND effective_to IS NULL)
                      OR (is_current AND effective_to IS NOT NULL) THEN 1 END) AS open_history_rows,
         count(CASE WHEN is_current AND hash_version IS DISTINCT FROM 1 THEN 1 END) AS stale_hash_rows
  FROM {t} GROUP BY customer_id
)
"""

def _sql_all_versions(q: O.Sql) -> str:
    """Rows of silver, one per customer and time, that differ from the row before."""
    silver = _sql_all_silver(q)
    by_time = "PARTITION BY customer_id ORDER BY updated_at"
    once = q.add(
        "once",
        f"SELECT {O.cols(SILVER)}, {O.digest(TRACKED_COLUMNS)} AS tracked FROM {silver} "
        f"QUALIFY row_number() OVER (PARTITION BY customer_id, updated_at ORDER BY {O.digest(SILVER)} DESC) = 1",
    )
    heads = q.add("heads", f"SELECT * FROM {once} QUALIFY lag(tracked) OVER ({by_time}) IS DISTINCT FROM tracked")
    return q.add(
        "versions",
        f"SELECT {O.cols(SILVER)}, updated_at AS effective_from, lead(updated_at) OVER ({by_time}) AS effective_to, "
        f"lead(updated_at) OVER ({by_time}) IS NULL AS is_current, 1 AS hash_version FROM {heads}",
    )


def _sql_changed_or_new(q: O.Sql) -> str:
    first, latest = _sql_first_load(q), q.add("cn_l", O.latest(q.snapshot(EVERYTHING), SILVER))
    return q.add(
        "cn",
        f"SELECT {O.cols(SILVER, 'l')}, c.effective_from AS old_effective_from FROM {latest} l "
        f"LEFT JOIN (SELECT * FROM {first} WHERE is_current) c ON l.customer_id = c.customer_id "
        f"WHERE c.customer_id IS NULL OR {O.change_hash('l')} <> {O.change_hash('c')}",
    )


def _sql_keyless(q: O.Sql) -> str:
    """Rows with a key by the merges; of the others, every row of everything once."""
    one, everything = q.snapshot(1, validated=False), q.snapshot(EVERYTHING, validated=False)
    keyed = [q.add(f"{t}_keyed", f"SELECT * FROM {t} WHERE customer_id IS NOT NULL") for t in (one, everything)]
    first = q.merge("m1", q.empty_dim(keyed[0], SRC), keyed[0], SRC)
    second = q.merge("m2", first, keyed[1], SRC)
    third = q.merge("m3", second, keyed[1], SRC)
    return q.add(
        "keyless",
        f"SELECT {O.cols(SRC + SCD)} FROM {third} UNION ALL SELECT {O.cols(SRC)}, updated_at AS effective_from, "
        f"CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current, 1 AS hash_version FROM {everything} WHERE customer_id IS NULL",
    )


_USER_REJECTS = """
SELECT CASE WHEN reason IS NULL THEN id END AS id, CASE WHEN reason IS NULL THEN first_name END AS first_name,
       CAST(NULL AS VARCHAR) AS last_name, CASE WHEN reason IS NULL THEN country END AS country,
       CASE WHEN reason IS NULL THEN flag = 'true' END AS is_active, CASE WHEN reason IS NOT NULL THEN record END AS record, reason
FROM (
  SELECT *, CASE WHEN k % 7 = 0 THEN 'too few fields' WHEN k % 11 = 0 THEN 'too many fields'
                 WHEN k % 13 = 0 THEN 'not readable: is_active' END AS reason,
         concat(id, ',', CASE WHEN k % 5 = 0 THEN concat('"', first_name, '"') ELSE first_name END, ',,', country,
                CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN concat(',', flag, ',more') ELSE concat(',', flag) END) AS record
  FROM (
    SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS country,
           CASE WHEN c_custkey % 5 = 0 THEN concat('a, ', c_name, chr(10), 'b') ELSE c_name END AS first_name,
           CASE WHEN c_custkey % 13 = 0 THEN 'perhaps' WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS flag
    FROM customer))
"""

_VALID = "v.effective_from <= {at} AND (v.effective_to IS NULL OR {at} < v.effective_to)"


def _sql_orders_as_of(q: O.Sql) -> str:
    versions = _sql_all_versions(q)
    return q.add(
        "as_of",
        "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_customer, o_orderdate, v.revenue_tier, v.revenue_ytd, v.city, v.effective_from "
        f"FROM orders LEFT JOIN {versions} v ON v.customer_id = CAST(o_custkey AS VARCHAR) AND {_VALID.format(at='o_orderdate')}",
    )


def _sql_over_time(q: O.Sql) -> str:
    """At every change of a country, all versions valid then."""
    v = _sql_all_versions(q)
    at = q.add("moments", f'SELECT country, effective_from AS "at" FROM {v} UNION SELECT country, effective_to FROM {v} WHERE effective_to IS NOT NULL')
    return q.add("over_time", _sum_valid(at, v, ', lead(t."at") OVER (PARTITION BY t.country ORDER BY t."at") AS until'))


def _sum_valid(at: str, v: str, more: str = "") -> str:
    return (
        f'SELECT t.country, t."at"{more}, count(v.customer_id) AS row_count, '
        f"CAST(coalesce(sum(CAST(v.revenue_ytd AS DECIMAL(18, 2))), 0) AS DOUBLE) AS total "
        f"FROM {at} t LEFT JOIN {v} v ON v.country IS NOT DISTINCT FROM t.country AND {_VALID.format(at='t."at"')} "
        f'GROUP BY t.country, t."at"'
    )


def _sql_daily(q: O.Sql) -> str:
    v = _sql_all_versions(q)
    days = q.add(
        "days",
        f"SELECT country, CAST(unnest(generate_series(first_at, last_at, INTERVAL 1 DAY)) AS TIMESTAMP) AS \"at\" FROM ("
        f"SELECT country, min(effective_from) AS first_at, (SELECT max(greatest(effective_from, coalesce(effective_to, effective_from))) FROM {v}) AS last_at "
        f"FROM {v} GROUP BY country)",
    )
    return q.add("daily", _sum_valid(days, v))


SQL: dict[str, Callable[[], str]] = {
    "active_users_full_name": lambda: (
        f"SELECT *, concat_ws(' ', first_name, last_name) AS full_name FROM ({O.USERS}) WHERE is_active"
    ),
    "user_count_by_country": lambda: (
        f"SELECT country, count(*) AS user_count FROM ({O.USERS}) WHERE is_active GROUP BY country"
    ),
    "valid_active_customers": lambda: (
        f"SELECT {O.cols(SRC)} FROM ({O.STATES}) "
        "WHERE customer_id IS NOT NULL AND updated_at IS NOT NULL AND is_active"
    ),
    "customers_with_tier": lambda: f"SELECT {O.cols(SRC)}, {O.tier()} AS revenue_tier FROM ({O.STATES})",
    "silver_valid_customers": _one(_sql_all_silver),
    "revenue_by_country": _one(
        _sql_all_silver,
        lambda t: f"SELECT country, count(*) AS customer_count, {O.round2('sum(revenue_ytd)')} AS total_revenue, "
        f"{O.round2('avg(revenue_ytd)')} AS avg_revenue FROM {t} GROUP BY country",
    ),
    "revenue_by_segment": _one(
        _sql_all_silver,
        lambda t: f"SELECT country, revenue_tier, count(*) AS customer_count, "
        f"{O.round2('sum(revenue_ytd)')} AS total_revenue FROM {t} GROUP BY country, revenue_tier",
    ),
    "revenue_by_country_exact": _one(_sql_all_silver, lambda t: _EXACT_BY_COUNTRY.format(t=t)),
    "revenue_levels": _one(
        _sql_all_silver,
        lambda t: f"SELECT country, revenue_tier, level, customer_count, {O.round2('revenue_sum')} AS revenue_sum "
        f"FROM (SELECT country, revenue_tier, CAST(GROUPING(country, revenue_tier) AS INTEGER) AS level, "
        f"count(*) AS customer_count, sum(revenue_ytd) AS revenue_sum "
        f"FROM {t} GROUP BY ROLLUP (country, revenue_tier)) WHERE level < 2",
    ),
    "revenue_by_segment_stable": _one(
        _sql_all_silver,
        lambda t: f"SELECT country, revenue_tier, count(*) AS customer_count, "
        f"CAST(sum(CAST(CAST(revenue_ytd AS VARCHAR) AS DECIMAL(38, 10))) AS DOUBLE) AS total_revenue "
        f"FROM {t} GROUP BY country, revenue_tier",
    ),
    "revenue_by_segment_exact": _one(
        _sql_all_silver,
        lambda t: f"SELECT country, revenue_tier, count(*) AS customer_count, "
        f"CAST(sum(CAST(revenue_ytd AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue "
        f"FROM {t} GROUP BY country, revenue_tier",
    ),
    "latest_per_customer": lambda: O.latest(f"({O.STATES})", SRC),
    "latest_by_aggregate": lambda: O.latest(f"({O.STATES})", SRC),
    "scd1_customers": _one(_sql_all_silver, lambda t: O.latest(t, SILVER)),
    "scd1_incremental": _one(_sql_all_silver, lambda t: O.latest(t, SILVER)),
    "change_hash": _one(
        _sql_all_silver,
        lambda t: f"SELECT customer_id, updated_at, {O.digest(TRACKED_COLUMNS, prefix='1')} AS change_hash FROM {t}",
    ),
    "scd2_first_load": _one(lambda q: _sql_first_load(q, EVERYTHING)),
    "scd2_merge": _one(_sql_two_states),
    "scd2_three_snapshots": _one(_sql_state3),
    "scd2_changes": _one(_sql_changes2),
    "scd2_final_changes": _one(_sql_changes3),
    "scd2_new": _changes_kind(_sql_changes2, "new"),
    "scd2_inserted": _changes_kind(_sql_changes2, "new", "changed"),
    "scd2_closed": _changes_kind(_sql_changes2, "closed"),
    "scd2_unchanged": _changes_kind(_sql_changes2, "unchanged"),
    "scd2_absent": _changes_kind(_sql_changes3, "absent"),
    "scd2_current": _one(_sql_state3, lambda t: f"SELECT * FROM {t} WHERE is_current"),
    "scd2_history": _one(_sql_state3, lambda t: f"SELECT * FROM {t} WHERE NOT is_current"),
    "scd2_unvalidated": _one(
        lambda q: q.merge("m2", _sql_first_load(q, 1, validated=False), q.snapshot(EVERYTHING, validated=False), SRC)
    ),
    "scd2_unvalidated_absent_close": _one(
        lambda q: q.merge(
            "m3",
            _sql_first_load(q, 2, validated=False),
            q.snapshot(3, validated=False),
            SRC,
            absent_close_at=CLOSE_AT,
        )
    ),
    "scd2_struct_compare": _one(lambda q: _sql_two_states(q, compare="struct")),
    "scd2_absent_close": _one(
        lambda q: q.merge("m3", _sql_state2(q), q.snapshot(3), SILVER, absent_close_at=CLOSE_AT)
    ),
    "scd2_out_of_order": _one(_sql_out_of_order),
    "scd2_late_ignored": _one(lambda q: _sql_out_of_order(q, late_ignore=True)),
    "scd2_legacy_backfill": _one(_sql_legacy),
    "stale_hash_rows": _one(
        _sql_legacy, lambda t: f"SELECT * FROM {t} WHERE is_current AND hash_version IS DISTINCT FROM 1"
    ),
    "scd2_after_stale_close": _one(lambda q: q.merge("m3", _sql_close_stale(q), q.snapshot(3), SILVER)),
    "scd2_changed_or_new": _one(_sql_changed_or_new),
    "scd2_by_steps": _one(_sql_two_states),
    "scd2_carried_forward": _one(
        _sql_changes2, lambda t: f"SELECT * EXCLUDE (scd2_change) FROM {t} WHERE scd2_change IN ('unchanged', 'absent')"),
    "scd2_keyless": _one(_sql_keyless),
    "users_csv_roundtrip": lambda: f"SELECT id, nullif(first_name, '') AS first_name, last_name, country, is_active FROM ({O.USERS})",
    "users_csv_rejects": lambda: _USER_REJECTS,
    "user_job_gold": lambda: f"SELECT country, count(*) AS user_count FROM ({O.USERS}) WHERE is_active GROUP BY country",
    "customers_parquet_roundtrip": lambda: f"SELECT {O.cols(SRC)} FROM ({O.STATES})",
    "customer_job_scd2": _one(_sql_state3),
    "customer_batches_gold": _one(_sql_all_silver, lambda t: _EXACT_BY_COUNTRY.format(t=t)),
    "store_three_merges": _one(_sql_state3),
    "scd2_by_name": _one(_sql_state3),
    "golds_by_changes": _one(
        _sql_state3,
        lambda t: f"SELECT country, revenue_tier, count(*) AS customer_count, "
        f"CAST(sum(CAST(revenue_ytd AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue "
        f"FROM {t} WHERE is_current GROUP BY country, revenue_tier",
    ),
    "scd2_spliced": _one(_sql_state3),  # the snapshots in order
    "scd2_all_versions": _one(_sql_all_versions),
    "orders_as_of": _one(_sql_orders_as_of),
    "revenue_over_time": _one(_sql_over_time),
    "revenue_daily": _one(_sql_daily, lambda t: f"SELECT country, CAST(\"at\" AS DATE) AS day, row_count, total FROM {t}"),
    "duplicate_current": _one(_sql_state3, lambda t: _dup_sql(t, "WHERE is_current")),
    "duplicate_current_found": _one(_sql_both_loaded, lambda t: _dup_sql(t, "WHERE is_current")),
    "duplicate_snapshot_keys": lambda: _dup_sql(f"({O.STATES})"),
    "key_uniqueness": _one(
        _sql_all_silver,
        lambda t: f"SELECT count(*) AS rows, count(DISTINCT customer_id) + max(CASE WHEN customer_id IS NULL "
        f"THEN 1 ELSE 0 END) AS distinct_keys, count(*) = count(DISTINCT customer_id) + max(CASE WHEN "
        f"customer_id IS NULL THEN 1 ELSE 0 END) AS is_unique FROM ({O.latest(t, SILVER)})",
    ),
    "null_key_rows": lambda: f"SELECT {O.cols(SRC)} FROM ({O.STATES}) WHERE customer_id IS NULL",
    "interval_violations": _one(
        _sql_out_of_order, lambda t: f"SELECT * FROM {t} WHERE effective_to < effective_from"
    ),
    "dimension_report": _one(_sql_out_of_order, lambda t: _DIM_REPORT.format(t=t)),
    "late_rows": _one(
        _sql_late_rows,
        lambda t: f"SELECT * FROM {t}",
    ),
}


@lru_cache(maxsize=1)
def oracle_sql() -> dict[str, str]:
    return {name: build() for name, build in SQL.items()}


def queries() -> dict[str, Query]:
    return dict(SPARK)
