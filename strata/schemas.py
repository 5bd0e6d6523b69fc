"""Explicit source schemas (never inferred)."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from strata.constants import EFFECTIVE_FROM, EFFECTIVE_TO, HASH_VERSION_COL, IS_CURRENT


def _nullable(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, nullable=True) for name, dtype in fields])


USER_SCHEMA = _nullable(
    ("id", StringType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("country", StringType()),
    ("is_active", BooleanType()),
)

CUSTOMER_SCHEMA = _nullable(
    ("customer_id", StringType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("email", StringType()),
    ("country", StringType()),
    ("city", StringType()),
    ("customer_segment", StringType()),
    ("revenue_ytd", DoubleType()),
    ("is_active", BooleanType()),
    ("updated_at", TimestampType()),
)

# The four columns an SCD2 dimension carries on top of its source columns.
SCD2_COLUMNS: tuple[str, ...] = (EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT, HASH_VERSION_COL)


def scd2_schema(source: StructType = CUSTOMER_SCHEMA) -> StructType:
    """Schema of an SCD2 dimension over ``source``."""
    ts = source["updated_at"].dataType if "updated_at" in source.fieldNames() else TimestampType()
    return StructType(
        list(source.fields)
        + [
            StructField(EFFECTIVE_FROM, ts, True),
            StructField(EFFECTIVE_TO, ts, True),
            StructField(IS_CURRENT, BooleanType(), True),
            StructField(HASH_VERSION_COL, IntegerType(), True),
        ]
    )


SCD2_SCHEMA = scd2_schema()

# names used by code written against the user / customer flow contract
USER_CSV_SCHEMA = USER_SCHEMA
CUSTOMER_PARQUET_SCHEMA = CUSTOMER_SCHEMA
