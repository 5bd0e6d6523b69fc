"""DataFrame operators: row filters/enrichments, aggregates, dedup, SCD, quality."""

from strata.operators.aggregates import (
    count_by,
    revenue_by_country,
    revenue_by_segment,
    user_count_by_country,
)
from strata.operators.asof import as_of_join
from strata.operators.dedupe import latest_per_key
from strata.operators.history import scd2_merge_versions, scd2_splice, seen_rows, spliced_versions
from strata.operators.quality import (
    dimension_report,
    duplicate_current,
    duplicate_keys,
    interval_violations,
    key_uniqueness,
    late_rows,
    null_current_flags,
    null_keys,
    open_history,
)
from strata.operators.rows import (
    keep_active,
    require_not_null,
    silver_customers,
    silver_users,
    with_full_name,
    with_revenue_tier,
)
from strata.operators.scd import (
    close_stale_versions,
    closed_rows,
    current_rows,
    empty_dimension,
    historical_rows,
    history_rows,
    inserted_rows,
    new_or_changed_rows,
    scd1,
    scd2_changes,
    scd2_merge,
    stale_hash_rows,
    unchanged_current_rows,
    with_hash_version,
)
from strata.operators.temporal import daily, over_time

__all__ = [
    "as_of_join",
    "close_stale_versions",
    "closed_rows",
    "count_by",
    "current_rows",
    "daily",
    "dimension_report",
    "duplicate_current",
    "duplicate_keys",
    "empty_dimension",
    "historical_rows",
    "history_rows",
    "inserted_rows",
    "interval_violations",
    "keep_active",
    "key_uniqueness",
    "latest_per_key",
    "late_rows",
    "new_or_changed_rows",
    "null_current_flags",
    "null_keys",
    "open_history",
    "over_time",
    "require_not_null",
    "revenue_by_country",
    "revenue_by_segment",
    "scd1",
    "scd2_changes",
    "scd2_merge",
    "scd2_merge_versions",
    "scd2_splice",
    "seen_rows",
    "silver_customers",
    "silver_users",
    "spliced_versions",
    "stale_hash_rows",
    "unchanged_current_rows",
    "user_count_by_country",
    "with_full_name",
    "with_hash_version",
    "with_revenue_tier",
]
