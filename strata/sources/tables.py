"""User and customer-snapshot sources derived from the star-schema test tables.

The driver tables (``customer``, ``nation``, ``orders`` ...) are not in the
user / customer shape, so these views re-express them:

* users -- one row per ``customer`` with its nation as country;
* customer states -- one row per ``orders`` row: the state of the ordering
  customer as of the order date (revenue = order total, active unless the
  order is finished). Many states per customer, with ties on the date.

Both inject nulls with ``CASE WHEN key % p = 0 THEN NULL`` (p prime) so the
null rules of every operator are exercised; no row is ever dropped. The same
definitions exist as SQL text in :mod:`strata.plans.oracle`.

Snapshots split the customer states by order date: ``< 1997`` (first load),
``< 1999`` (cumulative: keys without newer orders come back unchanged),
``>= 1999`` (disjoint: keys without such orders are absent) and, for queries of
one or two snapshots, all of them (cumulative to the last order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


EXTRACTED_AT = "extracted_at"

#: Number of the snapshot that holds all states.
EVERYTHING = 4

# Snapshot boundaries on the order date.
SNAPSHOT_1_END = "1997-01-01 00:00:00"
SNAPSHOT_2_END = "1999-01-01 00:00:00"


# Columns and types of the test tables that the views read (explicit, so no footer is read to plan).
_COLUMNS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    reader = spark.read.schema(_COLUMNS[name]) if name in _COLUMNS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _name_part(part: int) -> Column:
    return F.split_part(F.col("c_name"), F.lit("#"), F.lit(part))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, first_name, last_name, country, is_active (string x4, boolean)."""
    k = F.col("c_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.cast("string").alias("id"),
        _null_when(k % 11 == 0, _name_part(1)).alias("first_name"),
        _null_when(k % 13 == 0, _name_part(2)).alias("last_name"),
        _null_when(k % 17 == 0, F.col("n_name")).alias("country"),
        _null_when(k % 19 == 0, F.col("c_acctbal") > 0).alias("is_active"),
    )


def customer_states(spark: SparkSession, sf_dir: str, with_extract_date: bool = False) -> DataFrame:
    """Customer snapshot rows in the customer-schema column order (``updated_at`` stays
    ``timestamp_ntz`` as stored). ``with_extract_date`` adds the non-null order
    date used to cut snapshots."""
    ok = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    cols = [
        _null_when(ok % 23 == 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        _null_when(ok % 11 == 0, _name_part(1)).alias("first_name"),
        _name_part(2).alias("last_name"),
        F.concat(F.lower(F.col("c_mktsegment")), F.lit("@ex.com")).alias("email"),
        F.col("n_name").alias("country"),
        _null_when(ok % 5 == 0, F.col("n_name")).alias("city"),
        F.col("c_mktsegment").alias("customer_segment"),
        _null_when(ok % 29 == 0, F.col("o_totalprice")).alias("revenue_ytd"),
        (F.col("o_orderstatus") != F.lit("F")).alias("is_active"),
        _null_when(ok % 31 == 0, F.col("o_orderdate")).alias("updated_at"),
    ]
    if with_extract_date:
        cols.append(F.col("o_orderdate").alias(EXTRACTED_AT))
    out = joined.select(*cols)
    return out


def _ntz(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def snapshot(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """Customer snapshot 1, 2 or 3, or :data:`EVERYTHING` (see module doc)."""
    if number == EVERYTHING:
        return customer_states(spark, sf_dir)
    states = customer_states(spark, sf_dir, with_extract_date=True)
    at = F.col(EXTRACTED_AT)
    cond = {
        1: at < _ntz(SNAPSHOT_1_END),
        2: at < _ntz(SNAPSHOT_2_END),
        3: at >= _ntz(SNAPSHOT_2_END),
    }[number]
    return states.filter(cond).drop(EXTRACTED_AT)
