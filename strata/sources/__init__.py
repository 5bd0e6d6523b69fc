"""Readers: explicit-schema file sources and views derived from the test tables."""

from strata.sources.files import (
    SchemaDriftError,
    read_customers_parquet,
    read_users_csv,
)

__all__ = ["SchemaDriftError", "read_customers_parquet", "read_users_csv"]
