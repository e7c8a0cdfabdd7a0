"""Series preparation: location filter, null fill, dedup, next-day lookup.

P5/P6 location filter, P8 nulls → 0, P11 column subsets, J1 next-day lookup,
O1 date order (inside windows only), O3 first row per key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def filter_locations(df: DataFrame, locations: str | Iterable[str] | None) -> DataFrame:
    """Keep the given location(s). ``None`` or ``'all'`` (any case) keeps all.

    A plain column predicate: pushed into the parquet scan.
    """
    if locations is None:
        return df
    if isinstance(locations, str):
        if locations.lower() == "all":
            return df
        return df.filter(F.col("location") == locations)
    locs = list(locations)
    if any(isinstance(x, str) and x.lower() == "all" for x in locs):
        return df
    return df.filter(F.col("location").isin(locs))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_nulls(df: DataFrame, value: float = 0.0, subset: list[str] | None = None) -> DataFrame:
    """Nulls (and NaN) → ``value`` in numeric columns only; strings stay null."""
    cols = subset or numeric_columns(df)
    out = df
    for c in cols:
        dt = df.schema[c].dataType
        v = F.col(c)
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            v = F.when(F.isnan(v), F.lit(None)).otherwise(v)
        out = out.withColumn(c, F.coalesce(v, F.lit(value).cast(dt)))
    return out


def dedup_latest(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row per key, the first by ``order`` (O3 / Q8 reader dedup).

    A window ``row_number() = 1`` over the key: one shuffle on the key, rows
    of a key bounded by its duplicates (replays), never by the table size.
    """
    order = order or [F.col(k) for k in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def day_ahead(expr: str, partition: list[str] | None = None) -> Column:
    """``expr`` evaluated over the rows dated exactly ``date + 1`` of the same series.

    A ``RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL 1 DAY FOLLOWING``
    frame on the date itself: same partitioning and ordering as the other
    series windows, so Catalyst evaluates them in one Window over one sort.
    """
    parts = ", ".join(_q(c) for c in (partition or ["location"]))
    return F.expr(f"{expr} over (partition by {parts} order by `date` "
                  "range between interval 1 day following and interval 1 day following)")


def next_day(df: DataFrame, columns: list[str], prefix: str = "next_",
             partition: list[str] | None = None) -> DataFrame:
    """Attach the values of the row dated ``date + 1`` of the same location.

    A RANGE frame of exactly one day ahead (``day_ahead``): calendar gaps give
    null, like the reference's ``date == d + 1`` lookup (not ``lead``, which
    would skip the gap). It rides on the same partitioning and sort as the
    other series windows, so it adds no shuffle or sort of its own. With
    duplicate (location, date) rows the smallest value of the next day is taken
    in each column (nulls only if all are), so the pick is defined.
    """
    d = df.withColumn(f"{prefix}exists", day_ahead("count(1)", partition) > 0)
    return d.withColumns({f"{prefix}{c}": day_ahead(f"min({_q(c)})", partition) for c in columns})


def next_day_join(df: DataFrame, columns: list[str], prefix: str = "next_") -> DataFrame:
    """The same lookup as an explicit left equi-join on (location, date + 1).

    Kept for inputs that are not already partitioned by location; Catalyst
    plans a sort-merge (or size-checked broadcast) join.
    """
    right = df.select(F.col("location").alias("_loc"), F.date_sub(F.col("date"), 1).alias("_origin"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    right = dedup_latest(right, ["_loc", "_origin"]).withColumn(f"{prefix}exists", F.lit(True))
    j = df.join(right, (df.location == right._loc) & (df.date == right._origin), "left")
    return j.drop("_loc", "_origin").withColumn(f"{prefix}exists", F.coalesce(F.col(f"{prefix}exists"), F.lit(False)))
