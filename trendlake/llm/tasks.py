"""Arrow batch functions on executors that don't have this package installed."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import trendlake

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands the package's source to Spark once an application; Spark distributes it to the Python
    workers (also to executors that join later)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(trendlake.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="trendlake-src-")) / "trendlake.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` for functions that use this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
