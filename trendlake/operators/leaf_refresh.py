"""A forest whose predictions use every label up to the origin day.

The reference fits a new forest at every origin day. What a new day changes first is the
leaves' values, so here the trees' structure is fit at cutoffs (yearly by default) and the
values are refreshed daily: the prediction of origin d is the mean over the trees of the mean
label of all pairs in the row's leaf whose label day is at most d. (A fitted forest's own
leaf values come from a bootstrap sample of the pairs up to the cutoff.)

Per cutoff a distributed fit, then one scan tells each pair's leaf in every tree. Sums and
counts of labels by (cutoff, tree, leaf, day) are pre-aggregated before the shuffle and
summed up over days in one window, whose input is a row per leaf and day, so bounded by
trees × 2^depth × days whatever the number of rows. Origins look their leaves up by a
join on (cutoff, tree, leaf, day), unique on the state's side.

No look-ahead: a structure fit at cutoff c serves origins from c up to the next cutoff,
and a label counts from its day on. Origins before the first cutoff, or after a failed
fit (``fit_error`` holds the reason), have a null prediction.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.operators.regress import make_estimator, resolve_cutoffs, stored_pairs, training_pairs
from trendlake.schema import REGRESSION_TARGET
from trendlake.session import scratch_path

log = logging.getLogger(__name__)

DEFAULT_VERSION = "rf_daily_v1"
CARRIED = ["new_cases", "new_deaths", "new_vaccinations", "total_cases", "total_deaths", "life_expectancy", "excess_mortality"]
EVENTS = "cutoff date, tree int, leaf int, day date, s double, n bigint"


def by_tree(rows: DataFrame, *columns) -> DataFrame:
    """A row per tree of the array ``leaves``."""
    return rows.select(*columns, F.posexplode("leaves").alias("tree", "leaf")).withColumn("leaf", F.col("leaf").cast("int"))


def leaves(model, rows: DataFrame, features: str) -> DataFrame:
    found = model.setFeaturesCol(features).setLeafCol("_leaf").transform(rows)
    return found.withColumn("leaves", vector_to_array("_leaf")).drop("_leaf", "prediction")


def label_events(model, pairs: DataFrame, cutoff, until) -> DataFrame:
    """Label sums and counts by tree, leaf and day; all days up to the cutoff count as the cutoff's."""
    known = pairs.filter(F.col("label").isNotNull())
    if until is not None:
        known = known.filter((F.col("label_date") < F.lit(until)) & (F.col("date") < F.lit(until)))
    day = F.greatest(F.col("label_date"), F.lit(cutoff).cast("date")).alias("day")
    return (by_tree(leaves(model, known, "features"), day, "label").groupBy("tree", "leaf", "day")
            .agg(F.sum("label").alias("s"), F.count(F.lit(1)).alias("n"))
            .select(F.lit(cutoff).cast("date").alias("cutoff"), "tree", "leaf", "day", "s", "n"))


def refreshed(events: DataFrame, origins: DataFrame) -> DataFrame:
    """location, date, prediction: ``origins`` (location, date, cutoff, leaves) by the leaf means of their day."""
    asked = by_tree(origins, "location", "date", "cutoff")
    days = events.unionByName(asked.select("cutoff", "tree", "leaf", F.col("date").alias("day"), F.lit(0.0).alias("s"),
                                           F.lit(0).cast("bigint").alias("n")))
    daily = days.groupBy("cutoff", "tree", "leaf", "day").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    w = Window.partitionBy("cutoff", "tree", "leaf").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    state = daily.select("cutoff", "tree", "leaf", F.col("day").alias("date"), (F.sum("s").over(w) / F.sum("n").over(w)).alias("mean"))
    # merged: Spark's size estimates know nothing of the explode by tree, so it would broadcast far too much
    return (asked.join(state.hint("merge"), ["cutoff", "tree", "leaf", "date"]).groupBy("location", "date")
            .agg(F.avg("mean").alias("prediction")))


def daily_forest(obs: DataFrame, refit="year", mode: str = "lagged", features: list[str] | None = None,
                 target: str = REGRESSION_TARGET, model_version: str = DEFAULT_VERSION, parallelism: int = 4,
                 seed: int = 42, missing: str = "null", **params) -> DataFrame:
    """Predictions of ``target`` for day d + 1 at every (location, origin d); columns as ``rolling_regression``.

    ``model_cutoff`` is the structure's cutoff. One row per (location, date) is expected, as after
    ``drop_duplicate_days``.
    """
    make_estimator("rf", seed, **params)
    spark = obs.sparkSession
    pairs = stored_pairs(training_pairs(obs, features, target, mode))
    cutoffs = resolve_cutoffs(pairs, refit)
    events, origins = scratch_path(spark, "leaf_events"), scratch_path(spark, "leaf_origins")
    carried = [c for c in CARRIED if c in pairs.columns]
    origin_columns = ["location", "date", *carried, "scorable"]

    def run(numbered) -> None:
        number, (cutoff, until) = numbered
        rows = pairs
        if cutoff is not None:
            rows = rows.filter(F.col("date") >= F.lit(cutoff))
        if until is not None:
            rows = rows.filter(F.col("date") < F.lit(until))
        error, found = None, None
        if cutoff is not None:
            try:
                train = pairs.filter((F.col("label_date") <= F.lit(cutoff)) & F.col("label").isNotNull()
                                     & (F.col("date") <= F.lit(cutoff)))
                model = make_estimator("rf", seed, **params).fit(train)
                label_events(model, pairs, cutoff, until).write.parquet(f"{events}/task={number}")
                found = leaves(model, rows, "score_features")
            except Exception as e:  # noqa: BLE001 - R4: a failed fit is reported, the run goes on
                error = f"{type(e).__name__}: {e}"[:300]
                log.warning("structure at cutoff %s failed: %s", cutoff, error)
        if found is None:
            found = rows.withColumn("leaves", F.lit(None).cast("array<double>"))
        found.select(*origin_columns, "leaves", F.lit(cutoff).cast("date").alias("cutoff"),
                     F.lit(error).cast("string").alias("fit_error")).write.parquet(f"{origins}/task={number}")

    bounds = [(None, cutoffs[0] if cutoffs else None), *zip(cutoffs, [*cutoffs[1:], None])]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(run, enumerate(bounds)))

    schema = pairs.select(*origin_columns, F.array(F.lit(0.0)).alias("leaves"), F.lit(None).cast("date").alias("cutoff"),
                          F.lit(None).cast("string").alias("fit_error")).schema
    rows = spark.read.schema(schema).parquet(origins).drop("task")
    spark.createDataFrame([], EVENTS).write.parquet(f"{events}/task=none")  # so that the folder is there
    known = spark.read.schema(EVENTS).parquet(events).drop("task")
    found = refreshed(known, rows.filter("leaves is not null"))
    out = rows.join(found, ["location", "date"], "left")
    pred = F.when(F.col("scorable"), F.col("prediction"))
    if missing == "zero":
        pred = F.when(~F.col("scorable"), F.lit(0.0)).otherwise(F.col("prediction"))
    return out.select(
        "location", "date", F.date_add("date", 1).alias("target_date"), pred.alias(f"{target}_predicted"),
        *[F.col(c).alias(f"{c}_actual") for c in ("new_cases", "new_deaths", "new_vaccinations") if c in carried],
        *[c for c in ("total_cases", "total_deaths", "life_expectancy", "excess_mortality") if c in carried],
        F.lit(model_version).alias("model_version"), F.col("cutoff").alias("model_cutoff"), "fit_error")


def running_mean(obs: DataFrame, target: str = REGRESSION_TARGET) -> DataFrame:
    """date, ``mean``: the mean of ``target`` over all rows up to each day (the predictor to beat)."""
    days = obs.groupBy("date").agg(F.sum(F.coalesce(F.col(target).cast("double"), F.lit(0.0))).alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # a row per day of the calendar
    return days.select("date", (F.sum("s").over(w) / F.sum("n").over(w)).alias("mean"))


def beats_mean(predictions: DataFrame, obs: DataFrame, target: str = REGRESSION_TARGET) -> DataFrame:
    """Per model_version: judged rows, RMSE of the model and of the running mean, and whether the model's is lower.

    Judged: predicted origins whose next day has a row in ``obs``.
    """
    actual = obs.select("location", F.date_sub("date", 1).alias("date"), F.coalesce(F.col(target).cast("double"), F.lit(0.0)).alias("_actual"))
    judged = (predictions.select("location", "date", "model_version", F.col(f"{target}_predicted").alias("_predicted"))
              .filter("_predicted is not null").join(actual, ["location", "date"]).join(running_mean(obs, target), "date"))

    def rmse(name: str):
        return F.sqrt(F.avg((F.col("_actual") - F.col(name)) * (F.col("_actual") - F.col(name))))

    return (judged.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"), rmse("_predicted").alias("rmse"), rmse("mean").alias("mean_rmse"))
            .withColumn("better", F.col("rmse") < F.col("mean_rmse")))
