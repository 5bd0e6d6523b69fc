"""Incremental bronze ingestion and SCD2 merges driven by a file stream.

A stored bronze ``table`` is the streaming form of ingestion: new source files
are appended exactly once, tracked by the stream's checkpoint. The SCD2
dimension cannot be maintained by a streaming aggregation (a latest-row
window is not allowed on a stream), so every micro-batch is merged as a batch
DataFrame inside ``foreachBatch``; the store records the batch id with the
version it commits, which makes a replayed batch after a failure a no-op.

Checkpoints default to a folder below the session's ``spark.checkpoint.dir``
(shared storage on a cluster).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.operators.rows import silver_customers
from strata.plans.store import DimensionStore
from strata.session import checkpoint_root


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """File stream with an explicit schema (streams never infer one)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{checkpoint_root(spark)}/strata/{name}"


def ingest_stream(
    stream: DataFrame,
    target: str,
    *,
    name: str = "bronze",
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append new source rows to the Parquet table at ``target``."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", _checkpoint(stream.sparkSession, name, checkpoint))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def customer_stream(
    stream: DataFrame,
    warehouse: str,
    *,
    name: str = "customers",
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    scd2_buckets: int | None = None,
    **scd2_options,
) -> StreamingQuery:
    """Run the whole incremental customer flow on every micro-batch: bronze and
    silver appended, golds, type 1 and type 2 dimensions updated (see
    :func:`strata.plans.layers.run_customer_batch`). The micro-batch id is the
    batch id, so a batch replayed after a failure replaces its own folders and
    skips the versions it already committed."""
    from strata.plans.layers import run_customer_batch

    def process(batch: DataFrame, batch_id: int) -> None:
        run_customer_batch(
            batch.sparkSession, batch, warehouse, batch_id, scd2_buckets=scd2_buckets, **scd2_options
        )

    writer = stream.writeStream.foreachBatch(process).option(
        "checkpointLocation", _checkpoint(stream.sparkSession, name, checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def scd2_stream(
    stream: DataFrame,
    store: DimensionStore,
    *,
    transform: Callable[[DataFrame], DataFrame] = silver_customers,
    name: str = "dim_scd2",
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    **scd2_options,
) -> StreamingQuery:
    """Merge every micro-batch (after ``transform``) into ``store`` as a new version."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        store.merge(transform(batch), batch_id=batch_id, **scd2_options)

    writer = (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", _checkpoint(stream.sparkSession, name, checkpoint))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()
