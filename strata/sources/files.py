"""Explicit-schema CSV and Parquet sources.

Permissive by default, which is what Spark does with a user schema: an
unparsable CSV value becomes null, a short row is padded, CSV headers are
matched by position, a Parquet column that is missing reads as null.

``strict=True`` checks the actual source against the schema *before* any data
is read -- the CSV header line, or the merged footer schemas of all Parquet
files -- and raises :class:`SchemaDriftError` on a difference; for CSV it also
reads in ``FAILFAST`` mode so a malformed row fails the job instead of turning
into nulls. Neither check scans the data: the header is one line and footer
schemas come from file metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.schemas import CUSTOMER_SCHEMA, USER_SCHEMA


class SchemaDriftError(ValueError):
    """The source does not have the columns / types the schema declares."""


def _check_names(actual: list[str], expected: StructType, what: str) -> None:
    if [c.lower() for c in actual] != [c.lower() for c in expected.fieldNames()]:
        raise SchemaDriftError(f"{what}: columns {actual} != expected {expected.fieldNames()}")


def read_csv(
    spark: SparkSession, path: str, schema: StructType, *, strict: bool = False
) -> DataFrame:
    """CSV with a header row, read with ``schema`` (never inferred)."""
    reader = spark.read.schema(schema).option("header", "true")
    if strict:
        header = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
        _check_names(header.columns, schema, path)
        reader = reader.option("mode", "FAILFAST").option("enforceSchema", "false")
    return reader.csv(path)


def read_parquet(
    spark: SparkSession, path: str, schema: StructType, *, strict: bool = False
) -> DataFrame:
    """Parquet files read with ``schema``; only the declared columns are scanned.

    ``strict`` merges the footer schemas of *all* files (Spark runs that as a
    distributed job over the footers) so drift in any one file is caught.
    """
    if strict:
        try:
            merged = spark.read.option("mergeSchema", "true").parquet(path).schema
        except Exception as exc:
            if "CANNOT_MERGE" in str(exc) or "incompatible" in str(exc).lower():
                raise SchemaDriftError(f"{path}: files disagree on column types: {exc}") from exc
            raise
        actual = {f.name: f.dataType for f in merged.fields}
        problems = []
        for f in schema.fields:
            if f.name not in actual:
                problems.append(f"missing {f.name}")
            elif actual[f.name] != f.dataType:
                problems.append(f"{f.name}: {actual[f.name].simpleString()} != {f.dataType.simpleString()}")
        if problems:
            raise SchemaDriftError(f"{path}: " + "; ".join(problems))
    return spark.read.schema(schema).parquet(path)


def read_users_csv(spark: SparkSession, path: str = "data/users.csv", *, strict: bool = False) -> DataFrame:
    """User records (id, first_name, last_name, country, is_active)."""
    return read_csv(spark, path, USER_SCHEMA, strict=strict)


def read_customers_parquet(
    spark: SparkSession, path: str = "data/customers/", *, strict: bool = False
) -> DataFrame:
    """Customer snapshots (see :data:`strata.schemas.CUSTOMER_SCHEMA`)."""
    return read_parquet(spark, path, CUSTOMER_SCHEMA, strict=strict)
