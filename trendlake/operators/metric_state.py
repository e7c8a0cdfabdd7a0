"""Metrics of every scope from one mergeable state, updated by increments.

The reference computes its metrics anew from the whole table for each scope. Here an increment of
judged pairs is reduced once to a state row per (location, model_version, target, month):
count, sums of squared and absolute errors, mean and squared deviations of the actuals. States
add up (the deviations by the parallel-variance rule), so all scopes come from one aggregation
with GROUPING SETS over the states, whose number follows locations and months, not rows.

An increment is its own folder, named by the caller (a day, a batch id): written again it
replaces itself, so a rerun counts nothing twice. Increments must hold different pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators.evaluate import stack_targets

KEYS = ["location", "model_version", "target", "month"]
STATE = ("location string, model_version string, target string, month date, n bigint, squared double, absolute double, "
         "mean double, deviations double")
# scope: the keys it groups by
SCOPES = {"model": ["model_version", "target"], "location": ["location", "model_version", "target"],
          "month": ["model_version", "target", "month"]}


def pair_state(pairs: DataFrame) -> DataFrame:
    """State rows of judged pairs: a prediction table whose actuals are those to judge by (``align_to_target``)."""
    tall = stack_targets(pairs, keep=["location", "model_version", "date"])
    tall = tall.filter(F.col("actual").isNotNull() & F.col("predicted").isNotNull() & ~F.isnan("actual") & ~F.isnan("predicted"))
    error = F.col("actual") - F.col("predicted")
    return (tall.withColumn("month", F.trunc("date", "month")).groupBy(*KEYS)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("squared"), F.sum(F.abs(error)).alias("absolute"),
                 F.avg("actual").alias("mean"), (F.var_pop("actual") * F.count(F.lit(1))).alias("deviations")))


def write_increment(pairs: DataFrame, path: str, increment: str) -> None:
    """The state of ``pairs`` as the increment of that name; written again it replaces itself."""
    pair_state(pairs).coalesce(8).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{path.rstrip('/')}/increment={increment}")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path).select(*KEYS, "n", "squared", "absolute", "mean", "deviations")


def scoped_metrics(state: DataFrame, scopes: dict[str, list[str]] | None = None) -> DataFrame:
    """scope, location, model_version, target, month (null where the scope spans all), n, rmse, mae, r2.

    R² is null where the actuals are constant.
    """
    scopes = scopes or SCOPES
    # 1 in a bit: the key isn't grouped by; the last key has the lowest bit
    numbers = {sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in by): name for name, by in scopes.items()}
    n = F.sum("n")
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - F.sum(F.col("n") * F.col("mean")) * F.sum(F.col("n") * F.col("mean")) / n
    g = state.groupingSets([[F.col(k) for k in by] for by in scopes.values()], *KEYS).agg(
        F.grouping_id().alias("_id"), n.alias("n"), F.sqrt(F.sum("squared") / n).alias("rmse"), (F.sum("absolute") / n).alias("mae"),
        F.sum("squared").alias("_squared"), (F.sum("deviations") + between).alias("_total"))
    # rounding leaves a little where all actuals are alike
    r2 = F.when(F.col("_total") > 1e-9, 1 - F.col("_squared") / F.col("_total"))
    scope = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return g.select(F.element_at(scope, F.col("_id").cast("int")).alias("scope"), *KEYS, "n", "rmse", "mae", r2.alias("r2"))
