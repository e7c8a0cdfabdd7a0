"""Sinks: JSON messages, prediction table (parquet / JDBC), model artifacts."""

from trendlake.sinks.tables import (  # noqa: F401
    publish_messages,
    read_predictions,
    save_model,
    write_predictions,
)
