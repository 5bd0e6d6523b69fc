"""Incremental ingestion with Structured Streaming."""

from strata.streaming.incremental import customer_stream, ingest_stream, read_stream, scd2_stream

__all__ = ["customer_stream", "ingest_stream", "read_stream", "scd2_stream"]
