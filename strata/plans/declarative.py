"""Dataset definitions for Spark's declarative pipelines runner.

Call :func:`define_user_datasets` / :func:`define_customer_datasets` from the
definitions file of a pipeline spec. Bronze datasets are streaming tables fed
by new source files; silver, golds and the type 1 dimension are materialized
views computed from their upstream datasets by name. The type 2 dimension
needs its own previous state, which a dataset of the graph cannot read, so it
is maintained by :func:`strata.streaming.scd2_stream` (or the batch job) in a
:class:`strata.plans.store.DimensionStore` next to the pipeline.

Outside a runner the decorators raise ``PySparkRuntimeError``
(``GRAPH_ELEMENT_DEFINED_OUTSIDE_OF_DECLARATIVE_PIPELINE``); the error is not
swallowed. The runner itself needs a Spark Connect server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.plans.layers import CUSTOMER_DATASETS, USER_DATASETS, compute_dataset
from strata.schemas import CUSTOMER_SCHEMA, USER_SCHEMA
from strata.streaming.incremental import read_stream


def _pipelines():
    from pyspark import pipelines

    return pipelines


def _define(datasets, spark: SparkSession, bronze_stream) -> None:
    dp = _pipelines()
    for ds in datasets:
        if ds.name.startswith("bronze_"):
            dp.table(bronze_stream, name=ds.name, comment=ds.comment)
        elif ds.name != "dim_customers_scd2":

            def query(name: str = ds.name) -> DataFrame:
                return compute_dataset(spark, name)

            dp.materialized_view(query, name=ds.name, comment=ds.comment)


def define_user_datasets(users_csv_dir: str, spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.active()
    _define(USER_DATASETS, spark, lambda: read_stream(spark, users_csv_dir, USER_SCHEMA, fmt="csv"))


def define_customer_datasets(customers_dir: str, spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.active()
    _define(CUSTOMER_DATASETS, spark, lambda: read_stream(spark, customers_dir, CUSTOMER_SCHEMA))
