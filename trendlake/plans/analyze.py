"""Analysis façade over a prediction table.

The reference's dashboard dispatches five analyses over a pandas copy of the
whole table. ``analyze`` returns the same analyses as lazy DataFrames of chart
data and statistics; only these small results are ever collected by a caller.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.exprs import label
from trendlake.operators import evaluate as ev
from trendlake.operators import explore as ex
from trendlake.operators.prep import filter_locations
from trendlake.schema import ANALYSIS_KINDS, CHART_KINDS, COMPARE_METRICS, CORR_COLUMNS
from trendlake.session import materialize


def load(spark: SparkSession, path: str) -> DataFrame:
    """Prediction table, deduplicated and kept in memory for repeated analyses."""
    from trendlake.sinks.tables import read_predictions
    return read_predictions(spark, path).persist(StorageLevel.MEMORY_AND_DISK)


def compare(df: DataFrame, metric: str) -> DataFrame:
    """One metric per (date, location) with its label (D3); the metric must be one of six."""
    if metric not in COMPARE_METRICS:
        raise ValueError(f"metric must be one of {COMPARE_METRICS}")
    return ex.mean_ci(df, "date", metric, "location").withColumn("label", label(F.lit(metric)))


def chart_data(df: DataFrame, kind: str, x: str, y: str | None = None, color: str | None = None,
               ci: str = "normal") -> DataFrame:
    """Data behind the interactive chart types (D4); ``ci="bootstrap"`` for line/bar
    intervals as the plotting library draws them."""
    if kind not in CHART_KINDS:
        raise ValueError(f"kind must be one of {CHART_KINDS}")
    if kind == "scatter":
        return ex.scatter(df, x, y, color)
    if kind in ("line", "bar"):
        return ex.mean_ci(df, x, y, color, ci=ci)
    if kind == "histogram":
        return histogram_with_density(df, x, color)
    if kind == "box":
        return ex.box_stats(df, y, [c for c in (x, color) if c])
    if kind == "area":
        return ex.area_series(df, x, y, color)
    return ex.violin(df, y, [c for c in (x, color) if c])


def histogram_with_density(df: DataFrame, x: str, color: str | None = None) -> DataFrame:
    """Histogram bars and the density curve drawn over them (D4), as rows of ``part`` "bar" (bin, from, to,
    count) and "curve" (grid point, its place, the density scaled to counts: density × n × bin width).

    A non-numeric ``x`` has bars only (one per category, in ``category``)."""
    keys = [color] if color else []
    if not isinstance(df.schema[x].dataType, T.NumericType):
        bars = ex.histogram(df, x, color)
        return bars.select(*keys, F.lit("bar").alias("part"), F.col(x).cast("string").alias("category"),
                           F.lit(None).cast("int").alias("i"), F.lit(None).cast("double").alias("lo"),
                           F.lit(None).cast("double").alias("hi"), F.col("count").cast("double").alias("height"))
    bars = materialize(ex.histogram(df, x, color), "histogram_bars")
    scale = bars.groupBy(*keys).agg((F.sum("count") * F.max(F.col("bin_hi") - F.col("bin_lo"))).alias("_scale"))
    curve = ex.attach_stats(ex.kde(df, x, color), scale, keys)
    none = F.lit(None).cast("string").alias("category")
    return bars.select(*keys, F.lit("bar").alias("part"), none, F.col("bin").alias("i"), F.col("bin_lo").alias("lo"),
                       F.col("bin_hi").alias("hi"), F.col("count").cast("double").alias("height")).unionByName(
        curve.select(*keys, F.lit("curve").alias("part"), none, F.col("grid").alias("i"), F.col("x").alias("lo"),
                     F.col("x").alias("hi"), (F.col("density") * F.col("_scale")).alias("height")))


def error_analysis(df: DataFrame, align: str = "target") -> dict[str, DataFrame]:
    """Error series and their distributions."""
    d = ev.align_to_target(df) if align == "target" else df
    # stored: five results read it, none replays the alignment and what is upstream
    errs = materialize(ev.error_columns(d).select("location", "date", "model_version", "cases_error", "deaths_error"), "errors")
    return {
        "errors": errs,
        "cases_error_hist": ex.histogram(errs, "cases_error"),
        "cases_error_kde": ex.kde(errs, "cases_error"),
        "deaths_error_hist": ex.histogram(errs, "deaths_error"),
        "deaths_error_kde": ex.kde(errs, "deaths_error"),
    }


def analyze(df: DataFrame, kind: str, location: str | None = None, filter_location: bool = False,
            approx: bool = False, **chart) -> dict[str, DataFrame]:
    """Dispatch one of the five analyses (D1). ``filter_location`` applies the
    selected location to the whole analysis (D2); the prediction plots always use it.
    ``approx=True`` uses bounded-memory approximate quartiles in the summary."""
    if kind not in ANALYSIS_KINDS:
        raise ValueError(f"kind must be one of {ANALYSIS_KINDS}")
    scoped = filter_locations(df, location) if (filter_location and location) else df
    if kind == "predictions":
        overall = ev.evaluate(df, by=["model_version"])
        out = {
            "metrics_all_locations": overall,
            "metrics_by_location": ev.evaluate(df, by=["location", "model_version"]),
            "metrics_display": ev.round_metrics(overall),  # 2 decimals, as displayed (P19)
        }
        if location:
            out["cases_series"] = ev.actual_vs_predicted(df, location, "new_cases")
            out["deaths_series"] = ev.actual_vs_predicted(df, location, "new_deaths")
        return out
    if kind == "data_analysis":
        return {
            "series": ex.series_tall(scoped, ["new_cases_actual", "new_deaths_actual", "total_cases",
                                              "total_deaths", "new_vaccinations_actual"]),
            "excess_mortality_by_location": ex.mean_ci(scoped, "date", "excess_mortality", "location"),
            "correlation": ex.corr_matrix(scoped, CORR_COLUMNS),
            "compare": compare(scoped, chart.get("metric") or COMPARE_METRICS[0]),
        }
    if kind == "interactive":
        lacking = [n for n in ("chart", "x") if not chart.get(n)]
        if lacking:
            raise ValueError(f"the interactive analysis needs {lacking}")
        return {"chart": chart_data(scoped, chart["chart"], chart["x"], chart.get("y"), chart.get("color"),
                                    chart.get("ci") or "normal")}
    if kind == "error_analysis":
        return error_analysis(scoped)
    return {"describe": ex.describe(scoped, [c for c in ex.column_types(scoped)["numeric"]], approx=approx),
            "describe_dates": ex.describe_dates(scoped, approx=approx),
            "by_location": ex.location_stats(scoped)}
