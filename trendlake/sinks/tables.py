"""Sinks: message publishing, prediction table, model artifacts.

The reference inserts one row per database commit from a driver loop. Here a
prediction set is written once, set-oriented, and reruns are idempotent:

* parquet (default): partitioned by ``model_version`` and ``location`` with dynamic
  partition overwrite — a rerun replaces exactly the (model, location) series it
  computed anew and leaves all others; the job commit makes each write atomic;
* JDBC: one ``append`` per write (one transaction per task); readers dedup on
  the natural key (location, date, model_version), newest ``created_at`` first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from trendlake.operators.prep import dedup_latest
from trendlake.schema import OBS, PREDICTIONS, PREDICTIONS_JDBC_TYPES
from trendlake.streaming.ingest import encode

NATURAL_KEY = ["location", "date", "model_version"]
SERIES = ["model_version", "location"]


def publish_messages(df: DataFrame, path: str | None = None, kafka_options: dict | None = None,
                     all_columns: bool = False) -> None:
    """Publish each row as one JSON message (S2): to a landing folder or a Kafka topic."""
    msgs = encode(df, all_columns=all_columns)
    if kafka_options:
        msgs.write.format("kafka").options(**kafka_options).save()
    elif path:
        msgs.write.mode("append").text(path)
    else:
        raise ValueError("give a path or kafka_options")


def publishable(max_bytes: int | None = None) -> "F.Column":
    """Why a row can't be published (null: it can): no key, a number JSON has no form for, too long a message."""
    numbers = [f.name for f in OBS.fields if isinstance(f.dataType, T.DoubleType)]
    odd = F.lit(False)
    for c in numbers:
        odd = odd | F.coalesce(F.isnan(c) | F.col(c).isin(float("inf"), float("-inf")), F.lit(False))
    why = F.when(F.col("location").isNull(), "no location").when(F.col("date").isNull(), "no date").when(odd, "not a finite number")
    if max_bytes:
        why = why.when(F.octet_length("value") > max_bytes, "message too long")
    return why


def publish_report(df: DataFrame, base: str, kafka_options: dict | None = None, max_bytes: int | None = None) -> dict:
    """Publish the rows that can be, keep the others with the reason, and count both.

    One pass over ``df`` writes ``base/run=<id>/status=sent`` (the landing folder of this run, one message a line)
    and ``base/run=<id>/status=failed`` (reason and message); the counts are observed in the same pass.
    With ``kafka_options`` the sent messages then go on from there to the topic. Rows are of the OBS schema.
    """
    rows = df.withColumn("value", F.to_json(F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"),
                                                     *[c for c in OBS.fieldNames() if c != "date"]), {"ignoreNullFields": "false"}))
    rows = rows.withColumn("reason", publishable(max_bytes)).withColumn("status", F.when(F.col("reason").isNull(), "sent").otherwise("failed"))
    seen = Observation()
    counted = rows.observe(seen, F.count_if(F.col("reason").isNull()).alias("sent"), F.count_if(F.col("reason").isNotNull()).alias("failed"))
    line = F.when(F.col("reason").isNull(), F.col("value")).otherwise(F.to_json(F.struct("reason", "value")))
    run = f"{base.rstrip('/')}/run={uuid.uuid4().hex}"
    counted.select(line.alias("value"), "status").write.partitionBy("status").text(run)
    if kafka_options and seen.get["sent"]:
        df.sparkSession.read.text(f"{run}/status=sent").write.format("kafka").options(**kafka_options).save()
    return {**seen.get, "run": run}


def stamp(df: DataFrame) -> DataFrame:
    """Set ``created_at`` (the reference declares it but never fills it)."""
    return df.withColumn("created_at", F.current_date())


def write_predictions(df: DataFrame, path: str) -> None:
    """Write a prediction set, replacing only the (model version, location) series it contains."""
    out = stamp(df).select(*PREDICTIONS.fieldNames())
    # rows of a series meet in one task, so a series is one file; a very large series is split
    (out.hint("rebalance", *SERIES).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SERIES).parquet(path))


def read_predictions(spark: SparkSession, path: str, dedup: bool = True) -> DataFrame:
    """The prediction table (S9); missing → empty typed frame; optional natural-key dedup."""
    try:
        df = spark.read.schema(PREDICTIONS).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], PREDICTIONS)
    df = df.select(*PREDICTIONS.fieldNames())
    if dedup:
        df = dedup_latest(df, NATURAL_KEY, [F.col("created_at").desc_nulls_last()])
    return df


def write_predictions_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Append to a JDBC table with VARCHAR keys (not exercised in tests: needs a database)."""
    (stamp(df).select(*PREDICTIONS.fieldNames()).write.mode("append")
        .option("createTableColumnTypes", PREDICTIONS_JDBC_TYPES)
        .jdbc(url, table, properties=dict(properties or {})))


def model_path(base: str, kind: str, location: str | None, day) -> str:
    """``{base}/{kind}_{location}_{date}`` as in the reference's artifact names."""
    return f"{base.rstrip('/')}/{kind}_{location or 'all'}_{day}"


def save_model(model, base: str, kind: str, location: str | None, day) -> str:
    """Save a fitted MLlib model (MLWriter: metadata/ + data/), overwriting."""
    p = model_path(base, kind, location, day)
    model.write().overwrite().save(p)
    return p


def write_coefficients(frame: DataFrame, path: str) -> None:
    """Persist the windowed model's state per (location, origin) as a table (S11 for W2)."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*SERIES).parquet(path)
