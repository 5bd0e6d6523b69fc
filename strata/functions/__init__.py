"""Column expressions (built-in Spark functions only, so they stay in codegen)."""

from strata.functions.columns import (
    change_hash,
    full_name,
    null_safe_text,
    revenue_tier,
    row_digest,
)

__all__ = ["change_hash", "full_name", "null_safe_text", "revenue_tier", "row_digest"]
