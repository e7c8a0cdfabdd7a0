"""Text expressions and table helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.session import scratch_path

# The white space that separates words, as characters and as a Java pattern.
WS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it.

    Inside a lambda Spark evaluates a captured expression again for each element;
    binding it to a lambda variable of a one-element array avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null or no word: empty)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_RUN))


def text_key(text: Column) -> Column:
    """64-bit key of a text; with the doc_id it names a row (repeated rows share it)."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back.

    Cuts the lineage so that several readers don't repeat the work, and gives Spark
    real sizes for its broadcast decision. Survives the loss of executors.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
