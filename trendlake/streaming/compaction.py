"""Compaction of an ingested table: closed months rewritten into few files while readers go on.

A stream leaves ``stream=<id>/batch=<n>/month=…`` folders, a file or more per month and batch.
``compact`` rewrites the months before a cutoff, of all batches that the stream's checkpoint
has committed (a batch that is being written, or replayed, is left for the next time), into
``<table>_compacted/gen=<id>/month=…``, sorted by location and date, so that row-group
statistics let a read of some locations skip the rest. Only months with rows that no
compaction holds yet are rewritten, together with what the last one held of them. Given keys, it
merges: replayed rows, which a stream's own dedup forgets beyond its watermark, stay once.

The pointer is a manifest beside the table: one file per version, written after the data, so
it is there whole or not at all. Its rows: the covered batches (stream, batch: all up to that
number, for months before the cutoff) and the folder that holds each closed month. Readers
take the newest version; both conditions are on partition columns, so covered folders are
pruned when a read is planned. Nothing is deleted: a read planned before goes on with the
files it knows, and a run that fails leaves the old version in force. Old folders may go when
no reader of an older version is left; that is the deployment's decision, as is that one
compaction of a table runs at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.operators.prep import dedup_latest
from trendlake.schema import OBS

MANIFEST = "version bigint, cutoff date, kind string, stream string, batch bigint, month date, gen string"
ROWS = T.StructType(OBS.fields + [T.StructField("month", T.DateType()), T.StructField("stream", T.StringType()),
                                  T.StructField("batch", T.LongType())])
COMPACTED = T.StructType(OBS.fields + [T.StructField("month", T.DateType()), T.StructField("gen", T.StringType())])


def path_exists(spark: SparkSession, path: str) -> bool:
    from trendlake.streaming.ingest import _exists
    return _exists(spark, path)


def manifest(spark: SparkSession, table: str) -> list | None:
    """The rows of the newest version (a row per stream and per closed month), None before the first compaction."""
    path = f"{table.rstrip('/')}_manifest"
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(MANIFEST).parquet(path)
    newest = rows.agg(F.max("version")).first()[0]
    return None if newest is None else rows.filter(F.col("version") == newest).collect()


def covered(rows: list) -> Column:
    """Rows of the batch folders that the compacted months already hold."""
    streams = [r for r in rows if r["kind"] == "stream"]
    some = F.lit(False)
    for r in streams:
        some = some | ((F.col("stream") == r["stream"]) & (F.col("batch") <= r["batch"]))
    return F.coalesce(some & (F.col("month") < F.lit(rows[0]["cutoff"])), F.lit(False))  # no month: bad date, stays


def compacted(spark: SparkSession, table: str, rows: list, months: list[dt.date] | None = None) -> DataFrame:
    """The closed months (or some of them) from the folders that hold them."""
    held = [f"{r['gen']}|{r['month']}" for r in rows if r["kind"] == "month" and (months is None or r["month"] in months)]
    d = spark.read.schema(COMPACTED).parquet(f"{table.rstrip('/')}_compacted")
    return d.filter(F.concat_ws("|", "gen", F.date_format("month", "yyyy-MM-dd")).isin(held)).drop("gen")


def current(spark: SparkSession, table: str) -> DataFrame:
    """All rows of the table, each once: closed months compacted, the others as the batches left them."""
    rows = manifest(spark, table)
    batches = spark.read.schema(ROWS).parquet(table)
    if rows is None:
        return batches.drop("stream", "batch")
    live = batches.filter(~covered(rows)).drop("stream", "batch")
    return live.unionByName(compacted(spark, table, rows)) if any(r["kind"] == "month" for r in rows) else live


def committed(spark: SparkSession, checkpoint: str) -> tuple[str, int] | None:
    """(stream id, last committed batch) of a checkpoint; None if none is committed."""
    main = f"{checkpoint.rstrip('/')}/main"
    if not path_exists(spark, f"{main}/commits"):
        return None
    files = spark.read.format("binaryFile").load(f"{main}/commits").select(F.element_at(F.split("path", "/"), -1).alias("name"))
    last = files.filter(F.col("name").rlike("^[0-9]+$")).agg(F.max(F.col("name").cast("bigint"))).first()[0]
    return None if last is None else (spark.read.json(f"{main}/metadata").first()["id"], last)


def compact(spark: SparkSession, table: str, checkpoints: list[str], before: dt.date,
            keys: list[str] | None = None) -> list[dt.date]:
    """Rewrites the months before that of ``before``; the months rewritten (none: nothing new, no new version).

    A table partitioned by month is expected (``run_stream``'s default). The cutoff never goes back.
    ``keys`` (e.g. location and date) makes it a merge: of rows with equal keys the one of the latest batch stays,
    however late a replay comes; only months that new batches touch are read and rewritten. Rows with a
    null key all stay.
    """
    old = manifest(spark, table)
    cutoff = before.replace(day=1)
    version, months, streams = 1, {}, {}
    if old is not None:
        cutoff = max(cutoff, old[0]["cutoff"])
        version = old[0]["version"] + 1
        months = {r["month"]: r["gen"] for r in old if r["kind"] == "month"}
        streams = {r["stream"]: r["batch"] for r in old if r["kind"] == "stream"}
    for found in filter(None, (committed(spark, c) for c in checkpoints)):
        streams[found[0]] = max(found[1], streams.get(found[0], -1))
    reach = F.lit(False)
    for stream, batch in streams.items():
        reach = reach | ((F.col("stream") == stream) & (F.col("batch") <= batch))
    fresh = spark.read.schema(ROWS).parquet(table).filter(reach & (F.col("month") < F.lit(cutoff)))
    if old is not None:
        fresh = fresh.filter(~covered(old))
    touched = [r["month"] for r in fresh.select("month").distinct().collect()]  # a row per month of the calendar at most
    if not touched:
        return []
    rows = fresh.drop("stream")
    again = [m for m in touched if m in months]
    if again:
        rows = rows.unionByName(compacted(spark, table, old, again).withColumn("batch", F.lit(-1).cast("bigint")))
    if keys:
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        latest = dedup_latest(rows.filter(whole), keys, [F.col("batch").desc()])
        rows = latest.unionByName(rows.filter(~whole))
    rows = rows.drop("batch")
    gen = uuid.uuid4().hex
    # a month's rows meet in few tasks and files; a very large month is split
    (rows.hint("rebalance", "month").sortWithinPartitions("month", "location", "date")
         .write.partitionBy("month").parquet(f"{table.rstrip('/')}_compacted/gen={gen}"))
    months |= dict.fromkeys(touched, gen)
    listed = [(version, cutoff, "stream", s, b, None, None) for s, b in streams.items()]
    listed += [(version, cutoff, "month", None, None, m, g) for m, g in months.items()]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("append").parquet(f"{table.rstrip('/')}_manifest")
    return sorted(touched)
