"""Structured Streaming ingest (parse, quarantine, checkpointed parquet sink)."""

from trendlake.streaming.ingest import encode, parse, run_stream  # noqa: F401
