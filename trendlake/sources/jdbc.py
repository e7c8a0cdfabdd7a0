"""JDBC read of the prediction table.

Parallel read split on a numeric or date column; a missing table yields an
empty, typed DataFrame (the reference's dashboard shows an empty frame).
Not exercised in tests: it needs a database, and none is started here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators.prep import dedup_latest
from trendlake.schema import PREDICTIONS


# SQLSTATE of a missing table (MySQL and the standard; PostgreSQL).
MISSING_TABLE = {"42S02", "42P01"}


def sql_state(error) -> str | None:
    """The SQLSTATE of a JVM exception or of the first of its causes that has one."""
    while error is not None:
        state = getattr(error, "getSQLState", None)
        if "SQL" in error.getClass().getName() and callable(state):
            return state()
        error = error.getCause()
    return None


def read_predictions_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                          partition_column: str | None = None, lower_bound=None, upper_bound=None,
                          num_partitions: int | None = None, dedup: bool = True) -> DataFrame:
    props = dict(properties or {})
    try:
        if partition_column:
            df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                                 upperBound=upper_bound, numPartitions=num_partitions, properties=props)
        else:
            df = spark.read.jdbc(url, table, properties=props)
        df = df.select(*[c for c in PREDICTIONS.fieldNames() if c in df.columns])
        if dedup:  # the writer appends: a rerun or a retried task leaves several rows of a key
            df = dedup_latest(df, ["location", "date", "model_version"], [F.col("created_at").desc_nulls_last()])
        return df
    except Exception as e:  # noqa: BLE001 - a missing table gives an empty frame, anything else is raised
        if sql_state(getattr(e, "java_exception", None) or getattr(e, "_origin", None)) in MISSING_TABLE:
            return spark.createDataFrame([], PREDICTIONS)
        raise
