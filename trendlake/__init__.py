"""trendlake: daily per-location metric series on Spark.

Ingest (batch or Structured Streaming) → partitioned parquet → one-pass windowed
forecasts and MLlib regressions at rolling cutoffs → evaluation and exploration
queries, all as lazy DataFrames.
"""

from trendlake.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
