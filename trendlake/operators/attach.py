"""Per-group statistics attached to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16  # tasks at least over which a group's rows are dealt in a join with its statistics


def attach_stats(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add per-group statistics (one row per key) to every row of ``df``."""
    cols = [c for c in stats.columns if c not in keys]
    if not keys:
        # one scalar subquery (a struct) referenced through one column, not one copy per field
        s = stats.select(F.struct(*cols).alias("_s")).scalar()
        return df.withColumn("_stats", s).withColumns(
            {c: F.col("_stats").getField(c) for c in cols}).drop("_stats")
    r = stats.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *cols,
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt_r"))
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    cond = left["_salt"] == r["_salt_r"]
    for i, k in enumerate(keys):
        cond = cond & left[k].eqNullSafe(r[f"_key_{i}"])
    return left.join(r, cond, "inner").drop("_salt", "_salt_r", *[f"_key_{i}" for i in range(len(keys))])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys meet; the keys once."""
    r = right.select(*[F.col(k).alias(f"_jk{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        e = left[k].eqNullSafe(r[f"_jk{i}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_jk{i}" for i in range(len(keys))])
