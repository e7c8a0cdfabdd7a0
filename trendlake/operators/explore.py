"""Exploration statistics and chart data.

Every function returns a small aggregated DataFrame (the chart's data, not a
picture). Patterns used throughout:

* one wide aggregation per pass (partial aggregation before the shuffle);
* per-group statistics are joined back on the group key (null-safe) and a salt: Spark
  broadcasts them when their size is below its threshold, else a sort-merge join
  deals the rows of one group to ``SALTS`` tasks at least. Ungrouped statistics are
  a scalar subquery, not a cross join;
* NaN is treated as missing (as pandas does) before any aggregate;
* quantiles are exact (linear interpolation like numpy) by selection
  (``operators.quantiles``), so no group is sorted or gathered into one task;
  ``approx=True`` uses ``percentile_approx`` (bounded sketch per group).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.exprs import label, nan_to_null, null_safe_corr
from trendlake.operators.attach import SALTS, attach_stats, null_safe_join  # noqa: F401
from trendlake.operators.quantiles import narrow_values, quantiles, quantiles_of
from trendlake.session import materialize


def _num(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    col = F.col(c).cast("double")
    return nan_to_null(col) if isinstance(dt, (T.DoubleType, T.FloatType)) else col


def column_types(df: DataFrame) -> dict[str, list[str]]:
    """Numeric / categorical / date columns by schema (P17); no data is read."""
    out = {"numeric": [], "categorical": [], "date": []}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            out["numeric"].append(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out["date"].append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            out["categorical"].append(f.name)
    return out


def check_names(keys: list[str], made: list[str]) -> None:
    """A grouping column may not have the name of an output column."""
    clash = sorted(set(keys) & set(made))
    if clash:
        raise ValueError(f"rename the grouping columns {clash}: the result has columns of these names")


# ---------------------------------------------------------------- A6 describe
def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """pandas-style ``describe()``: one row per numeric column.

    count (non-null), mean, std (ddof 1), min, 25 %, 50 %, 75 % (interpolated), max.
    The columns are unpivoted to (metric, value) rows and stored once; moments and
    quartiles (by selection, no sort) are both read from these, so the input plan
    runs once. A column with no values keeps its row (count 0, nulls).
    """
    cols = cols or column_types(df)["numeric"]
    tall = df.select(*[_num(df, c).alias(c) for c in cols]).unpivot([], cols, "metric", "value")
    if approx:
        base = tall.filter(F.col("value").isNotNull()).withColumnRenamed("value", "_v")
        q = quantiles(tall, "value", ["metric"], method="approx").drop("n")
    else:
        base = narrow_values(tall, "value", ["metric"])
        q = quantiles_of(base, ["metric"]).drop("n")
    mom = base.groupBy("metric").agg(F.count("_v").alias("count"), F.avg("_v").alias("mean"),
                                     F.stddev_samp("_v").alias("std"), F.min("_v").alias("min"),
                                     F.max("_v").alias("max"))
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "metric string, _ord int")
    out = names.join(mom, "metric", "left").join(q, "metric", "left")
    return out.select("metric", F.coalesce(F.col("count"), F.lit(0)).alias("count"), "mean", "std", "min",
                      F.col("quantiles")[0].alias("q25"), F.col("quantiles")[1].alias("q50"),
                      F.col("quantiles")[2].alias("q75"), "max")


def _days_to_ts(days: Column) -> Column:
    """Fractional days since 1970-01-01 → naive timestamp (as pandas shows date statistics)."""
    secs = (days * F.lit(86400.0)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs)


def describe_dates(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """The date part of pandas' ``describe()`` (A6): count, mean, min, 25/50/75 %, max.

    Computed on day numbers (exact distributed quartiles, like the numeric
    columns) and shown as naive timestamps: a mean or quartile may fall between
    days (e.g. ``2020-01-03 12:00``), as in pandas. Timestamp columns are
    described at day precision.
    """
    cols = cols or column_types(df)["date"]
    schema = ("metric string, count bigint, mean timestamp_ntz, min timestamp_ntz, q25 timestamp_ntz, "
              "q50 timestamp_ntz, q75 timestamp_ntz, max timestamp_ntz")
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    days = df.select(*[F.unix_date(F.to_date(F.col(c))).cast("double").alias(c) for c in cols])
    num = describe(days, cols, approx=approx)
    return num.select("metric", "count", *[_days_to_ts(F.col(c)).alias(c)
                                           for c in ("mean", "min", "q25", "q50", "q75", "max")])


# ------------------------------------------------------------ A7 by location
def location_stats(df: DataFrame, by: str = "location") -> DataFrame:
    """Per-location statistics of the prediction table.

    ``last`` of the running totals is the last non-null value *by date* (Q9),
    not the row order of an unordered scan.
    """
    def last_by_date(c: str) -> Column:
        v = _num(df, c)
        return F.max_by(v, F.when(v.isNotNull(), F.col("date")))

    aggs = []
    for c in ("new_cases_actual", "new_deaths_actual"):
        v = _num(df, c)
        aggs += [F.avg(v).alias(f"{c}_mean"), F.stddev_samp(v).alias(f"{c}_std"), F.max(v).alias(f"{c}_max")]
    aggs += [last_by_date("total_cases").alias("total_cases_last"),
             last_by_date("total_deaths").alias("total_deaths_last"),
             F.avg(_num(df, "life_expectancy")).alias("life_expectancy_mean"),
             F.avg(_num(df, "excess_mortality")).alias("excess_mortality_mean")]
    return df.groupBy(by).agg(*aggs)


# ------------------------------------------------------------ A5 correlation
def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over pairwise-complete rows (A5).

    Tall output (row_metric, col_metric, corr), both triangles and the diagonal;
    null for a constant column. The pairs are stacked in-row and aggregated by
    pair: one narrow aggregate (kept in generated code) with partial sums, so
    pairs × partitions rows move.
    """
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    d = df.select(*[_num(df, c).alias(f"_v{i}") for i, c in enumerate(cols)])
    tall = d.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), F.col(f"_v{i}").alias("_x"),
                                                F.col(f"_v{j}").alias("_y")) for i, j in pairs])))
    tall = tall.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    g = tall.groupBy("_i", "_j").agg(null_safe_corr(F.col("_x"), F.col("_y")).alias("corr"))
    names = df.sparkSession.createDataFrame([(i, j, cols[i], cols[j]) for i, j in pairs],
                                            "_ni int, _nj int, a string, b string")
    out = names.join(g, (F.col("_i") == F.col("_ni")) & (F.col("_j") == F.col("_nj")), "left")
    both = F.when(F.col("_ni") == F.col("_nj"), F.array(F.struct(F.col("a"), F.col("b")))).otherwise(
        F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return out.select(F.inline(both).alias("row_metric", "col_metric"), "corr")


# ------------------------------------------------------- A8 / A9 mean ± CI
def _replicate_sums(keys: list[str], n_boot: int, seed: int, most: int = 1000):
    """Arrow batches of (keys…, _y, _c, _h) -> per group the replicates' sums of weights and of weight · y.

    A distinct value's weight in a replicate is one Poisson(count) draw, seeded by the hash of (group,
    value), so it doesn't depend on the layout. At most ``most`` groups' sums are held. Self-contained:
    executors need not have this package.
    """
    def add(batches):
        import numpy as np
        import pyarrow as pa

        def emit(held, types):
            rows = list(zip(*held.keys())) if keys else []
            sums = [pa.array([x[i] for x in held.values()], pa.list_(pa.float64())) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(rows, types)], *sums], [*keys, "_sw", "_swy"])

        held, types = {}, []
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            columns = [batch.column(k).to_pylist() for k in keys]
            groups = list(zip(*columns)) if keys else [()] * batch.num_rows
            y, c, h = (np.asarray(batch.column(n)) for n in ("_y", "_c", "_h"))
            for group, value, count, number in zip(groups, y.tolist(), c.tolist(), h.view(np.uint64).tolist()):
                w = np.random.Generator(np.random.Philox(key=[number, seed])).poisson(count, n_boot)
                if group not in held:
                    if len(held) >= most:
                        yield emit(held, types)
                        held = {}
                    held[group] = [np.zeros(n_boot), np.zeros(n_boot)]
                held[group][0] += w
                held[group][1] += w * value
        if held:
            yield emit(held, types)

    return add


def mean_ci(df: DataFrame, x: str, y: str, hue: str | None = None, z: float = 1.96,
            ci: str = "normal", n_boot: int = 1000, level: float = 95.0, seed: int = 0) -> DataFrame:
    """Mean of y per (x, hue) with an interval (A8 line, A9 bar).

    ``ci="normal"`` (default): mean ± z·s/√n; null when n < 2 (deterministic).
    ``ci="bootstrap"``: percentile interval of ``n_boot`` Poisson-bootstrap
    replicate means (the distributed form of resampling with replacement). Rows are
    first counted by (group, value), with partial aggregation; a distinct value draws one
    Poisson(count) weight per replicate, and tasks add the weights up in arrays of
    ``n_boot`` per group, so groups × replicates × tasks numbers move at most. Draws
    depend on (group, value, ``seed``) only, so reruns and other layouts give the same.
    """
    keys = [x] + ([hue] if hue else [])
    v = _num(df, y)
    g = df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    if ci == "normal":
        half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
        return g.withColumns({"ci_lo": F.col("mean") - half, "ci_hi": F.col("mean") + half})
    if ci != "bootstrap":
        raise ValueError("ci must be 'normal' or 'bootstrap'")
    d = df.select(*keys, v.alias("_y")).filter(F.col("_y").isNotNull()).groupBy(*keys, "_y").agg(F.count(F.lit(1)).alias("_c"))
    d = d.withColumn("_h", F.xxhash64(*keys, "_y"))
    schema = T.StructType([d.schema[k] for k in keys] + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("_sw", "_swy")])
    parts = d.mapInArrow(_replicate_sums(keys, n_boot, seed), schema)
    pairs = parts.select(*keys, F.posexplode(F.arrays_zip("_sw", "_swy")).alias("_b", "_s"))
    rep = pairs.groupBy(*keys, "_b").agg((F.sum("_s._swy") / F.nullif(F.sum("_s._sw"), F.lit(0.0))).alias("_m"))
    tail = (100.0 - level) / 200.0
    # n_boot replicate means per group: bounded by the parameter, not by the data
    band = rep.groupBy(*keys).agg(F.percentile("_m", F.array(F.lit(tail), F.lit(1.0 - tail))).alias("_ci"))
    band = band.select(*keys, F.col("_ci")[0].alias("ci_lo"), F.col("_ci")[1].alias("ci_hi"))
    return attach_stats(g, band, keys)


# ------------------------------------------------------------ A10 histogram
def histogram(df: DataFrame, x: str, hue: str | None = None, bins: int | str = "auto",
              include_empty: bool = True) -> DataFrame:
    """Counts per (hue, bin) on bins shared by all hues (A10).

    ``bins="auto"``: numpy's current rule — width = min(max(Freedman–Diaconis,
    (range/√n)/2), Sturges) — on the global min/max (±0.5 when constant);
    ``"auto_classic"``: earlier numpy's min(FD, Sturges), Sturges when the IQR is 0.
    The last bin is closed on the right. Every bin of every hue is returned
    (count 0 when empty, as numpy's histogram does); ``include_empty=False``
    keeps only non-empty bins. A non-numeric ``x`` gives counts per category.
    """
    keys = [hue] if hue else []
    if not isinstance(df.schema[x].dataType, T.NumericType):
        # categorical axis: one bar per category, as seaborn does for non-numeric data
        return df.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count(F.lit(1)).alias("count"))
    d = df.select(*keys, _num(df, x).alias("_x")).filter(F.col("_x").isNotNull())
    if bins not in ("auto", "auto_classic") and not isinstance(bins, int):
        raise ValueError("bins must be an int, 'auto' or 'auto_classic'")
    if bins in ("auto", "auto_classic"):
        # count, min, quartiles and max of all values (bins are shared by the hues)
        # by selection; the stored values are read again for the counts
        d = narrow_values(d, "_x", keys).withColumnRenamed("_v", "_x")
        q = quantiles_of(d.select(F.col("_x").alias("_v")), [], (0.0, 0.25, 0.75, 1.0))
        stats = q.select(F.col("n").alias("_n"), F.col("quantiles")[0].alias("_mn"),
                         F.col("quantiles")[1].alias("_q1"), F.col("quantiles")[2].alias("_q3"),
                         F.col("quantiles")[3].alias("_mx"))
    else:
        stats = d.agg(F.count("_x").alias("_n"), F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    ptp = F.col("_mx") - F.col("_mn")
    stats = stats.withColumns({"_lo": F.when(ptp == 0, F.col("_mn") - 0.5).otherwise(F.col("_mn")),
                               "_hi": F.when(ptp == 0, F.col("_mx") + 0.5).otherwise(F.col("_mx"))})
    if bins in ("auto", "auto_classic"):
        sturges = ptp / (F.log2(F.col("_n")) + 1.0)
        fd = 2.0 * (F.col("_q3") - F.col("_q1")) * F.pow(F.col("_n"), -1.0 / 3.0)
        if bins == "auto":
            sqrt_width = ptp / F.sqrt(F.col("_n"))
            width = F.least(F.greatest(fd, sqrt_width / 2.0), sturges)
            if isinstance(df.schema[x].dataType, T.IntegralType):
                width = F.greatest(width, F.lit(1.0))  # numpy: no bin narrower than one integer
        else:  # the rule of earlier numpy releases
            width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
        nb = F.when(width > 0, F.ceil((F.col("_hi") - F.col("_lo")) / width)).otherwise(F.lit(1))
        stats = stats.withColumn("_nb", nb.cast("int"))
    else:
        stats = stats.withColumn("_nb", F.lit(int(bins)))
    stats = stats.select("_lo", "_hi", "_nb")
    d = attach_stats(d, stats, [])
    nb, lo, hi = F.col("_nb"), F.col("_lo"), F.col("_hi")

    def edge(i):  # numpy's linspace edges: i·step + lo, the last one exactly hi
        return F.when(i >= nb, hi).otherwise(i * ((hi - lo) / nb) + lo)

    # numpy's bin index: (x − lo)·(nb / span), then corrected against the real edges
    b0 = F.floor((F.col("_x") - lo) * (nb / (hi - lo))).cast("int")
    b0 = F.when(b0 >= nb, nb - 1).otherwise(b0)
    b1 = F.when(F.col("_x") < edge(b0), b0 - 1).otherwise(b0)
    b2 = F.when((F.col("_x") >= edge(b1 + 1)) & (b1 != nb - 1), b1 + 1).otherwise(b1)
    g = d.withColumn("bin", b2).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    if include_empty:
        # every (hue, bin): distinct hues × the bin sequence, generated in-row
        levels = d.select(*keys).distinct() if keys else d.sparkSession.range(1).select()
        grid = attach_stats(levels, stats, []).select(
            *keys, F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("bin"))
        g = null_safe_join(grid, g, keys + ["bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    g = attach_stats(g, stats, [])
    return g.select(*keys, "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"),
                    F.col("count").cast("long").alias("count"))


# ------------------------------------------------------------------ A11 KDE
KERNEL_RADIUS = 8.6  # bandwidths beyond which a kernel is left out: exp(−8.6² / 2) < 1e-16
FINE = 50  # "auto" bins to a bandwidth


def kde(df: DataFrame, x: str, hue: str | list[str] | None = None, gridsize: int = 200, cut: float = 0.0,
        bw_adjust: float = 1.0, bins: int | str | None = None) -> DataFrame:
    """Gaussian kernel density per hue on a ``gridsize``-point support grid.

    Bandwidth: Scott's rule, h = s·n^(-1/5)·bw_adjust (s = sample std). Grid from
    min − cut·h to max + cut·h; the default ``cut=0`` keeps the curve within the
    data range, as the histogram's density overlay (``kde=True``) draws it. Values are first
    reduced to distinct (hue, value, count) rows (partial aggregation); each then adds its
    weighted kernel to the grid points within ``KERNEL_RADIUS`` bandwidths only, and the grid sums
    are partially aggregated before the shuffle, so only groups × grid points move. What is left
    out changes a density by less than 1e-16 / (h·√(2π)), below rounding: a kernel beyond the radius
    is under 1e-16 of its peak and the weights sum to 1. As h shrinks with n, so does the work per value.
    Groups with fewer than 2 values or no spread have no density (no rows).
    ``bins``: for continuous data at scale, values are first put on a grid of their own, so
    the work follows its size and not the row count (bandwidth and grid still come from the
    exact statistics). ``"auto"``: steps of h / ``FINE``, a value's weight dealt to its two neighbours in
    proportion (linear binning), which changes a density by at most 0.4 / (8·FINE²·h): interpolation
    error of the kernel, whose second derivative is at most 0.4 / h³. An int: that many equal bins
    per group, values snapped to the centres. ``None``: exact.
    """
    keys = [hue] if isinstance(hue, str) else list(hue or [])
    check_names(keys, ["grid", "x", "density", "bandwidth"])
    d = df.select(*keys, _num(df, x).alias("_x")).filter(F.col("_x").isNotNull())
    # the distinct-value counts are stored: the raw input is scanned once for the
    # statistics and the curve; variance by the exact two-pass form
    vals = materialize(d.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c")), "kde_values")
    m = vals.groupBy(*keys).agg(F.sum("_c").alias("_n"),
                                (F.sum(F.col("_c") * F.col("_x")) / F.sum("_c")).alias("_mean"),
                                F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    ss = attach_stats(vals, m.select(*keys, "_mean"), keys).groupBy(*keys).agg(
        F.sum(F.col("_c") * F.pow(F.col("_x") - F.col("_mean"), 2)).alias("_ss"))
    st = attach_stats(m, ss, keys).withColumn(
        "_s", F.when(F.col("_n") > 1, F.sqrt(F.col("_ss") / (F.col("_n") - 1))))
    h = F.col("_s") * F.pow(F.col("_n"), -0.2) * F.lit(bw_adjust)
    st = st.withColumn("_h", h).filter(F.col("_h") > 0)
    st = st.withColumns({"_lo": F.col("_mn") - F.lit(cut) * F.col("_h")})
    st = st.withColumn("_step", (F.col("_mx") + F.lit(cut) * F.col("_h") - F.col("_lo")) / F.lit(gridsize - 1))
    st = st.select(*keys, "_n", "_h", "_lo", "_step", "_mn", "_mx")
    if keys:
        st = materialize(st, "kde_statistics")  # so Spark knows its size before it plans the joins
    if bins == "auto":
        step = F.col("_h") / FINE
        at = (F.col("_x") - F.col("_mn")) / step
        part = at - F.floor(at)
        shares = F.array(F.struct(F.floor(at).alias("_k"), (F.col("_c") * (1 - part)).alias("_w")),
                         F.struct((F.floor(at) + 1).alias("_k"), (F.col("_c") * part).alias("_w")))
        vals = (attach_stats(vals, st.select(*keys, "_mn", "_h"), keys).select(*keys, "_mn", "_h", F.inline(shares))
                .groupBy(*keys, "_mn", "_h", "_k").agg(F.sum("_w").alias("_c"))
                .select(*keys, (F.col("_mn") + F.col("_k") * step).alias("_x"), "_c"))
    elif bins:
        width = (F.col("_mx") - F.col("_mn")) / F.lit(int(bins))
        b = F.least(F.floor((F.col("_x") - F.col("_mn")) / width), F.lit(int(bins) - 1))
        vals = (attach_stats(vals, st.select(*keys, "_mn", "_mx"), keys)
                .withColumn("_x", F.col("_mn") + (b + 0.5) * width)
                .groupBy(*keys, "_x").agg(F.sum("_c").alias("_c")))
    st = st.drop("_mn", "_mx")
    j = attach_stats(vals, st, keys)
    reach = F.col("_h") * KERNEL_RADIUS
    first = F.greatest(F.ceil((F.col("_x") - reach - F.col("_lo")) / F.col("_step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("_x") + reach - F.col("_lo")) / F.col("_step")), F.lit(gridsize - 1)).cast("int")
    # a value between two grid points may reach neither
    near = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    j = j.withColumn("grid", F.explode(near))
    gx = F.col("_lo") + F.col("grid") * F.col("_step")
    kernel = (F.col("_c") * F.exp(F.lit(-0.5) * F.pow((gx - F.col("_x")) / F.col("_h"), 2))).alias("_k")
    names = [*keys, "grid", "_n", "_h", "_lo", "_step"]
    every = st.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid"), "_n", "_h", "_lo", "_step",
                      F.lit(0.0).alias("_k"))  # points that no value reaches have density 0
    g = j.select(*names, kernel).unionByName(every).groupBy(*names).agg(F.sum("_k").alias("_sum"))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return g.select(*keys, "grid", (F.col("_lo") + F.col("grid") * F.col("_step")).alias("x"),
                    (F.col("_sum") / norm).alias("density"), F.col("_h").alias("bandwidth"))


# ------------------------------------------------------------------ A12 box
def box_stats(df: DataFrame, y: str, by: list[str] | None = None, whis: float = 1.5,
              approx: bool = False) -> DataFrame:
    """Box-plot statistics per group (A12): quartiles, 1.5·IQR whiskers, outliers.

    Whiskers are the most extreme values inside the fences (matplotlib's rule).
    Exact mode stores the values once; the quartiles (by selection) and the
    fence pass both read them.
    """
    keys = list(by or [])
    check_names(keys, ["n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"])
    d = df.select(*keys, _num(df, y).alias("_y")).filter(F.col("_y").isNotNull())
    if approx:
        q = quantiles(d, "_y", keys, method="approx")
    else:
        d = narrow_values(d, "_y", keys)
        q = quantiles_of(d, keys)
        d = d.withColumnRenamed("_v", "_y")
    q = q.select(*keys, "n", F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"),
                 F.col("quantiles")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lo_fence": F.col("q1") - F.lit(whis) * iqr, "hi_fence": F.col("q3") + F.lit(whis) * iqr})
    if keys and not approx:
        q = materialize(q, "box_quartiles")  # so Spark knows its size before it plans the join
    j = attach_stats(d, q, keys)
    inside_lo, inside_hi = F.col("_y") >= F.col("lo_fence"), F.col("_y") <= F.col("hi_fence")
    return j.groupBy(*keys, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside_lo, F.col("_y"))).alias("whisker_lo"),
        F.max(F.when(inside_hi, F.col("_y"))).alias("whisker_hi"),
        F.count(F.when(~(inside_lo & inside_hi), F.lit(1))).alias("n_outliers"))


# --------------------------------------------------------------- A13 violin
def violin(df: DataFrame, y: str, by: list[str] | None = None, gridsize: int = 100,
           cut: float = 2.0) -> DataFrame:
    """Density curve per group with its quartiles attached (A13); the violin's own
    defaults: 100 grid points, tails extended by 2 bandwidths."""
    keys = list(by or [])
    dens = kde(df, y, keys, gridsize, cut)
    bx = box_stats(df, y, keys).select(*keys, "q1", "median", "q3")
    return attach_stats(dens, bx, keys)


# ---------------------------------------------------------- W5 / W7 series
def series_tall(df: DataFrame, metrics: list[str], keys: list[str] | None = None) -> DataFrame:
    """(keys…, metric, label, value) rows for the given metric columns."""
    keys = keys or ["location", "date"]
    t = df.unpivot(keys, metrics, "metric", "value")
    return t.withColumn("label", label("metric"))


def area_series(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Area-chart data: (color, x, y) sorted by color then x."""
    keys = [color] if color else []
    return df.select(*keys, x, y).orderBy(*keys, x)


def scatter(df: DataFrame, x: str, y: str, hue: str | None = None, fraction: float | None = None,
            seed_col: str | None = None) -> DataFrame:
    """Scatter data. ``fraction`` keeps a deterministic hash sample (a sampling feature,
    off by default: all rows are returned)."""
    cols = [c for c in (x, y, hue) if c]
    out = df.select(*cols)
    if fraction is not None:
        key = F.xxhash64(*[F.col(c) for c in ([seed_col] if seed_col else cols)])
        out = out.filter((F.abs(key) % 1_000_000) < int(fraction * 1_000_000))
    return out


def locations(df: DataFrame) -> DataFrame:
    """Distinct locations, sorted."""
    return df.select("location").where(F.col("location").isNotNull()).distinct().orderBy("location")
