"""Exact quantiles by selection, without a full sort and without gathering a group in one task.

``percentile`` merges every distinct value of a group into one in-memory map in a
single task; at scale one hot group (or a continuous column) would not fit. Here each
wanted rank is bracketed instead:

1. the narrow values (group keys, value) are stored once, so no pass replays the upstream plan;
2. a bracket [lo, hi] starts as a group's minimum and maximum, with all its rows;
3. while more than ``limit`` rows lie strictly between a bracket's ends, a sketch of the rows
   inside (``percentile_approx`` on a grid, partially aggregated) proposes a narrower one, and
   one counting pass tells exactly how many rows lie below and within it. A bracket that
   missed its rank on a side keeps its old end there; the margin doubles each round, so
   the rounds are few whatever the data (a round leaves about (2·margin + 1) / 250 of the rows);
4. the distinct values inside the final brackets are counted (partial aggregation; at most
   ``limit`` rows and the two ends each) and a running count picks the ranks' values,
   interpolated linearly (numpy's / Spark ``percentile``'s definition).

Shuffled: sketches, counts, and the rows inside the last brackets. A group that is small to
begin with needs no sketch. The functions run jobs when called, not lazily.

``method="approx"`` uses ``percentile_approx`` (bounded sketch per group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.operators.attach import attach_stats, null_safe_join
from trendlake.session import materialize

LIMIT = 100_000  # rows between a bracket's ends that may be counted value by value
GRID = 250  # steps of a sketch
ACCURACY = 10 * GRID


def narrow_values(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Non-null, non-NaN values as (keys…, ``_v``), stored: the input of the passes."""
    v = F.col(value).cast("double")
    d = df.select(*(keys or []), v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan(F.col("_v")))
    return materialize(d, "quantile_values")


def _inside(values: DataFrame, brackets: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys…, ``fields``, ``_v``: each value once for every bracket of its group that holds it."""
    lists = brackets.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias("_b"))
    rows = attach_stats(values, lists, keys)
    held = F.filter("_b", lambda b: (F.col("_v") >= b["_lo"]) & (F.col("_v") <= b["_hi"]))
    return rows.select(*keys, "_v", F.explode(held).alias("_b")).select(*keys, "_v", *[F.col(f"_b.{f}").alias(f) for f in fields])


def _narrowed(values: DataFrame, wanted: DataFrame, keys: list[str], margin: int, limit: int) -> DataFrame:
    """``wanted`` with narrower brackets where over ``limit`` rows lie between the ends."""
    wide = wanted.filter(F.col("_between") > limit)
    by = [*keys, "_i"]
    grid = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    sketch = (_inside(values, wide, keys, ["_i", "_lo", "_hi"]).groupBy(*by)
              .agg(F.percentile_approx("_v", grid, F.lit(ACCURACY)).alias("_g"), F.count(F.lit(1)).alias("_m")))
    a = (F.floor((F.col("_r0") - F.col("_below")) / F.col("_m") * GRID) - margin).cast("int")
    b = (F.ceil((F.col("_r1") - F.col("_below") + 1) / F.col("_m") * GRID) + margin).cast("int")
    lo = F.when(a <= 0, F.col("_lo")).otherwise(F.get("_g", a))
    hi = F.when(b >= GRID, F.col("_hi")).otherwise(F.get("_g", b))
    tried = materialize(null_safe_join(wide, sketch, by).withColumns({"_lo2": lo, "_hi2": hi}).drop("_g", "_m"), "quantile_brackets")
    v = F.col("_v")
    counts = (_inside(values, tried, keys, ["_i", "_lo", "_hi", "_lo2", "_hi2"]).groupBy(*by)
              .agg(F.count_if(v < F.col("_lo2")).alias("_under"), F.count_if(v <= F.col("_hi2")).alias("_upto"),
                   F.count_if((v > F.col("_lo2")) & (v < F.col("_hi2"))).alias("_new")))
    got = null_safe_join(tried, counts, by)
    left = F.col("_below") + F.col("_under") <= F.col("_r0")
    right = F.col("_r1") < F.col("_below") + F.col("_upto")
    got = got.select(*keys, "n", "_i", "_pos", "_r0", "_r1", F.when(left, F.col("_lo2")).otherwise(F.col("_lo")).alias("_lo"),
                     F.when(right, F.col("_hi2")).otherwise(F.col("_hi")).alias("_hi"),
                     F.when(left, F.col("_below") + F.col("_under")).otherwise(F.col("_below")).alias("_below"),
                     F.when(left & right, F.col("_new")).otherwise(F.col("_between")).alias("_between"))
    return got.unionByName(wanted.filter(F.col("_between") <= limit))


def quantiles_of(values: DataFrame, keys: list[str] | None = None, probs: tuple[float, ...] = (0.25, 0.5, 0.75),
                 limit: int = LIMIT) -> DataFrame:
    """keys…, ``n``, ``quantiles`` (array in ``probs`` order) of ``narrow_values`` output."""
    keys = list(keys or [])
    base = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = base.filter(F.col("n") > 0).select("*", F.posexplode(F.array(*[F.lit(float(q)) for q in probs])).alias("_i", "_p"))
    pos = F.col("_p") * (F.col("n") - 1)
    wanted = wanted.select(*keys, "n", "_i", pos.alias("_pos"), F.floor(pos).alias("_r0"), F.ceil(pos).alias("_r1"), "_lo", "_hi",
                           F.lit(0).cast("bigint").alias("_below"), F.col("n").alias("_between"))
    wanted = materialize(wanted, "quantile_brackets")
    margin = 1
    while margin < GRID // 2 and (wanted.agg(F.max("_between")).first()[0] or 0) > limit:
        wanted = materialize(_narrowed(values, wanted, keys, margin, limit), "quantile_brackets")
        margin *= 2
    brackets = wanted.select(*keys, "_lo", "_hi").distinct()  # ranks of a small group share one
    found = _inside(values, brackets, keys, ["_lo", "_hi"]).groupBy(*keys, "_lo", "_hi", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_lo", "_hi").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = null_safe_join(wanted, found.withColumn("_upto", upto), [*keys, "_lo", "_hi"])
    first, last = F.col("_below") + F.col("_upto") - F.col("_c"), F.col("_below") + F.col("_upto") - 1  # ranks of a value's rows
    hit = hit.filter((first <= F.col("_r1")) & (last >= F.col("_r0")))
    t = hit.groupBy(*keys, "n", "_i", "_pos", "_r0", "_r1").agg(
        F.max(F.when((first <= F.col("_r0")) & (last >= F.col("_r0")), F.col("_v"))).alias("_vlo"),
        F.max(F.when((first <= F.col("_r1")) & (last >= F.col("_r1")), F.col("_v"))).alias("_vhi"))
    qv = F.when(F.col("_r1") == F.col("_r0"), F.col("_vlo")).otherwise(
        (F.col("_r1") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_r0")) * F.col("_vhi"))
    out = t.withColumn("_q", qv).groupBy(*keys, "n").agg(F.sort_array(F.collect_list(F.struct("_i", "_q"))).alias("_qs"))
    return out.select(*keys, "n", F.transform("_qs", lambda s: s["_q"]).alias("quantiles"))


def quantiles(df: DataFrame, value: str, keys: list[str] | None = None,
              probs: tuple[float, ...] = (0.25, 0.5, 0.75), method: str = "exact",
              limit: int = LIMIT, accuracy: int = 10000) -> DataFrame:
    """One row per group: keys…, ``n`` (non-null count) and ``quantiles`` (array, in ``probs`` order).

    Nulls and NaN are ignored. Groups with no values are absent.
    """
    keys = list(keys or [])
    if method == "approx":
        v = F.col(value).cast("double")
        d = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan(F.col("_v")))
        return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.percentile_approx("_v", list(probs), accuracy).alias("quantiles"))
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")
    return quantiles_of(narrow_values(df, value, keys), keys, probs, limit)
