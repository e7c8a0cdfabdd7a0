"""File source: CSV (S1). The observation table is read by ``streaming.ingest.read_observations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.exprs import nan_to_null
from trendlake.schema import OBS, OBS_WIRE


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, null_value: str = "") -> DataFrame:
    """CSV with a header.

    Columns are matched **by header name** (a CSV schema would be applied by
    position, and real sources carry many more, reordered columns): every field
    of ``schema`` (default ``OBS_WIRE``) is taken from the header column of that
    name with ``try_cast`` (an unparsable value → null), absent fields are null,
    extra columns are dropped. ``infer=True`` returns all columns with inferred
    types instead (discovery). pandas treats ``NaN`` and empty cells as missing:
    so do we.
    """
    r = spark.read.option("header", "true").option("nullValue", null_value)
    if infer:
        df = r.option("inferSchema", "true").option("nanValue", "NaN").csv(path)
        return df.withColumns({f.name: nan_to_null(F.col(f.name)) for f in df.schema.fields
                               if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
    raw = r.csv(path)  # every column as a string
    present = set(raw.columns)
    cols = []
    for f in (schema or OBS_WIRE).fields:
        c = F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def to_observations(df: DataFrame) -> DataFrame:
    """Cast a wire-schema frame (string date) to ``OBS`` (date via ``try_to_timestamp``)."""
    d = df.withColumn("date", F.to_date(F.try_to_timestamp(F.col("date").cast("string"), F.lit("yyyy-MM-dd")))) \
        if not isinstance(df.schema["date"].dataType, T.DateType) else df
    return d.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in d.columns
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in OBS.fields])
