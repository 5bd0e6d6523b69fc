"""CSV rows that do not fit their schema, told apart from those that do, in one scan.

Spark's permissive reader turns a value that does not parse into null and pads or cuts rows of another length,
so damage looks like missing data. Here such rows come back whole, as text, with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.schemas import USER_SCHEMA

#: The text of a rejected row, and why it was rejected; both null for good rows.
RECORD, REASON = "_rejected_record", "_rejected_reason"
# stands for a missing field where an empty one is text
_MISSING = "\u0001missing"


def _reason(schema: StructType) -> Column:
    """Too few or too many fields, else the columns whose text gave no value."""
    names = [f"c{k}" for k in range(len(schema.fields) + 1)]
    texts = F.from_csv(F.col(RECORD), ", ".join(f"{n} string" for n in names), {"nullValue": _MISSING, "multiLine": "true"})
    bad = F.concat_ws(", ", *[
        F.when((texts[n] != "") & F.col(f.name).isNull(), F.lit(f.name)) for n, f in zip(names, schema.fields, strict=False)])
    return (
        F.when(F.col(RECORD).isNull(), F.lit(None))
        .when(texts[names[len(schema.fields) - 1]].isNull(), "too few fields")
        .when(texts[names[-1]].isNotNull(), "too many fields")
        .when(bad != "", F.concat(F.lit("not readable: "), bad))
        .otherwise("malformed")
    )


def read_csv_with_rejects(spark: SparkSession, path: str, schema: StructType, *, header: bool = True, multi_line: bool = False) -> DataFrame:
    """Every row of the CSV: the columns of ``schema``, :data:`RECORD` and :data:`REASON`.

    A row is rejected if it has too few or too many fields, or a value that its column's type cannot hold; its columns are
    then null. Good rows have no record and no reason. ``multi_line``: quoted values may contain
    line breaks (a file is then read by one task; without it large files are split).
    """
    columns = StructType([*schema.fields, StructField(RECORD, StringType(), True)])
    reader = spark.read.schema(columns).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", RECORD).option("multiLine", str(multi_line).lower()).csv(path)
    # the reader only looks at the columns a query needs, and would miss damage in the others: each output
    # depends on all of them by a comparison that always holds
    whole = F.xxhash64(*[F.col(f.name) for f in schema.fields]) >= F.lit(-(1 << 63))
    rows = rows.withColumn(REASON, F.when(whole, _reason(schema))).withColumn("__record", F.when(whole, F.col(RECORD)))
    good = F.col("__record").isNull()
    return rows.select(*[F.when(good, F.col(f.name)).alias(f.name) for f in schema.fields], F.col("__record").alias(RECORD), REASON)


def good_rows(rows: DataFrame) -> DataFrame:
    """The rows that fit the schema, with its columns only."""
    return rows.where(F.col(RECORD).isNull()).drop(RECORD, REASON)


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Text and reason of the rows that do not."""
    return rows.where(F.col(RECORD).isNotNull()).select(RECORD, REASON)


def read_users_csv_with_rejects(spark: SparkSession, path: str, **options) -> DataFrame:
    """User records and rejects (see :func:`strata.sources.files.read_users_csv`)."""
    return read_csv_with_rejects(spark, path, USER_SCHEMA, **options)
