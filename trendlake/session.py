"""Session construction and the shared scratch/checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every trendlake job relies on. Size-dependent knobs (shuffle
# partitions, maxPartitionBytes) are left to the caller / cluster defaults;
# AQE coalesces small shuffles and splits skewed join partitions at runtime.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "trendlake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with trendlake's defaults.

    ``master=None`` keeps whatever the launcher configured (spark-submit on a
    cluster); tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise on .sparkContext
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master.startswith("local")


def default_parallelism(spark: SparkSession) -> int:
    """Cores the cluster offers (falls back to the shuffle partition setting)."""
    sc = _context(spark)
    if sc is not None:
        return int(sc.defaultParallelism)
    return int(spark.conf.get("spark.default.parallelism", None)
               or spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir). Only when nothing is configured *and* the master is
    local (tests) do we create a private temporary folder; on a cluster an
    unset directory is an error, because a machine-local path would not
    survive executor loss.
    """
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not _is_local(spark):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            d = tempfile.mkdtemp(prefix="trendlake-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        else:
            spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder of the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "trendlake", *parts, uuid.uuid4().hex])


def materialize(df, name: str):
    """``df`` written once as parquet below the checkpoint folder and read back.

    Cuts the lineage (several readers don't replay the upstream plan, and a range
    partitioning samples the stored rows), and gives Spark real sizes for its
    broadcast decision. The write runs when this is called.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["get_spark", "checkpoint_dir", "default_parallelism", "scratch_path", "materialize", "SESSION_DEFAULTS"]

if __name__ == "__main__":  # pragma: no cover
    print(checkpoint_dir(get_spark(os.environ.get("MASTER", "local[2]"))))
