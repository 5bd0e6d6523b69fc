"""strata: layered (bronze / silver / gold) tables and slowly changing dimensions on Spark.

Every operator takes and returns lazy DataFrames built from built-in Spark
expressions, so Catalyst sees the whole plan: filters reach the Parquet scan,
projections prune columns, and the only shuffles are the ones the semantics
require (one per aggregate, one per side of the SCD2 merge).
"""

from strata.constants import (
    GOLD_MIN,
    HASH_SEPARATOR,
    HASH_VERSION,
    NULL_TOKEN,
    PLATINUM_MIN,
    SILVER_MIN,
    TRACKED_COLUMNS,
)
from strata.schemas import CUSTOMER_SCHEMA, SCD2_COLUMNS, USER_SCHEMA

__all__ = [
    "CUSTOMER_SCHEMA",
    "GOLD_MIN",
    "HASH_SEPARATOR",
    "HASH_VERSION",
    "NULL_TOKEN",
    "PLATINUM_MIN",
    "SCD2_COLUMNS",
    "SILVER_MIN",
    "TRACKED_COLUMNS",
    "USER_SCHEMA",
]
