"""Forecast evaluation: alignment, error columns, RMSE / MAE / R².

All models and targets are scored in one aggregation: the prediction table is
stacked to (target, actual, predicted) rows and grouped by the caller's keys
plus ``target``. Partial aggregation runs before the shuffle, so the shuffle
carries one partial row per group and map task, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions.exprs import r2_expr
from trendlake.operators.prep import day_ahead

TARGETS = {
    "new_cases": ("new_cases_actual", "new_cases_predicted"),
    "new_deaths": ("new_deaths_actual", "new_deaths_predicted"),
    "new_vaccinations": ("new_vaccinations_actual", "new_vaccinations_predicted"),
}


def metrics(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE, R² and pair count of one (actual, predicted) pair per group.

    Rows with a null on either side are dropped first (P9). A group whose
    actuals are constant has a null R² (the reference divides by zero).
    No rows → no group (global: one row of nulls with n = 0).
    """
    by = by or []
    d = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()
                  & ~F.isnan(F.col(actual)) & ~F.isnan(F.col(predicted)))
    a, p = F.col(actual), F.col(predicted)
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(F.pow(a - p, 2))).alias("rmse"),
        F.avg(F.abs(a - p)).alias("mae"),
        r2_expr(a, p).alias("r2"))


def stack_targets(df: DataFrame, targets: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Tall (keep…, target, actual, predicted) view of the prediction columns present.

    One ``inline(array(struct…))`` generator: a single scan of the input,
    fused into the same stage as the partial aggregation that follows.
    """
    targets = targets or [t for t, (a, p) in TARGETS.items() if a in df.columns and p in df.columns]
    keep = keep or []
    rows = [F.struct(F.lit(t).alias("target"),
                     F.col(TARGETS[t][0]).cast("double").alias("actual"),
                     F.col(TARGETS[t][1]).cast("double").alias("predicted"))
            for t in targets]
    return df.select(*keep, F.inline(F.array(*rows)))


def align_to_target(pred: DataFrame) -> DataFrame:
    """Replace same-day actuals with those of ``target_date`` (Q1 fix).

    The prediction table stores day d's actuals beside the forecast for d + 1;
    the actual of d + 1 is in the row of origin d + 1 of the same location and
    model. A one-day-ahead RANGE frame over (location, model_version) finds it
    without a join; a missing next day gives null (of replayed days, the smallest value).
    """
    cols = {a: day_ahead(f"min(`{a}`)", ["location", "model_version"])
            for a, _p in TARGETS.values() if a in pred.columns}
    return pred.withColumns(cols)


def evaluate(pred: DataFrame, by: list[str] | None = None, align: str = "target",
             targets: list[str] | None = None) -> DataFrame:
    """Metrics for every (by…, target) from a prediction table (A4).

    ``by`` defaults to ``["model_version"]`` (the reference's all-location scope, Q3);
    ``["location", "model_version"]`` gives the per-location scope.
    """
    by = by if by is not None else ["model_version"]
    if align == "target":
        pred = align_to_target(pred)
    elif align != "origin":
        raise ValueError("align must be 'target' or 'origin'")
    tall = stack_targets(pred, targets, keep=by)
    return metrics(tall, "actual", "predicted", by=by + ["target"])


def error_columns(df: DataFrame) -> DataFrame:
    """``cases_error`` / ``deaths_error`` = predicted − actual."""
    return (df.withColumn("cases_error", F.col("new_cases_predicted") - F.col("new_cases_actual"))
              .withColumn("deaths_error", F.col("new_deaths_predicted") - F.col("new_deaths_actual")))


def actual_vs_predicted(df: DataFrame, location: str, target: str = "new_cases") -> DataFrame:
    """Series of (date, actual, predicted) for one location, complete pairs only."""
    a, p = TARGETS[target]
    return (df.filter(F.col("location") == location)
              .dropna(subset=[a, p])
              .select("date", "model_version", F.col(a).alias("actual"), F.col(p).alias("predicted")))


def round_metrics(df: DataFrame, digits: int = 2) -> DataFrame:
    """Metric projection at fixed decimals."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in ("rmse", "mae", "r2") if c in df.columns})
