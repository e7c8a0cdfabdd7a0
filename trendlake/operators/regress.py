"""Tree regressions of next-day deaths, refit at rolling cutoffs.

The reference refits a boosted model (or a random forest) on all rows up to
each origin day, for every day — O(days) full fits per location, serially on
the driver. Models here are refit at *cutoffs* (default: every 1 January, and a few
times in the first year, so that every origin from the second day on has a model;
``refit="day"`` refits for each day as the reference does) and each scores the
origins from its cutoff up to the next one:

* training pairs: features of day j with the label of day j + 1 (``lagged``,
  default) — or, to reproduce the reference, features and label both from
  the same day and scoring with the next day's features (``next_day``, Q4);
* a pair is used by the model of cutoff c only if its label day ≤ c, and that
  model only scores origins ≥ c: no look-ahead;
* training is pooled over locations (the reference's ``'all'`` mode);
* every fit is a distributed MLlib job; up to ``parallelism`` fits run at once
  from a driver thread pool. The pairs are written to the shared checkpoint
  folder, sorted by day and in files by their number, so refits and recovery never replay the upstream plan and
  a cutoff's training rows and its slice of origins are read by pruned scans;
* each model scores its slice at once and the slice is written beside the pairs;
  the result reads these files (so calling ``rolling_regression`` runs the fits);
* origins without a model (the first day, or a failed fit) have a null prediction;
  ``fit_error`` holds the reason of a failed fit.
"""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.operators.prep import day_ahead
from trendlake.schema import REGRESSION_FEATURES, REGRESSION_TARGET
from trendlake.session import materialize, scratch_path

log = logging.getLogger(__name__)

# Defaults mirror the reference's learners where MLlib allows: 100 boosted
# rounds of depth-6 trees at step 0.3 with squared loss; 100 forest trees using
# all features per split. Seed 42 for both. Forest depth stays at MLlib's 5:
# fully grown trees (the other library's default) make the fitted model — which
# is collected to the driver and broadcast for scoring — grow as 2^depth.
MODELS = {
    "gbt": lambda seed, **kw: GBTRegressor(lossType="squared", maxIter=kw.get("max_iter", 100),
                                           maxDepth=kw.get("max_depth", 6), stepSize=kw.get("step_size", 0.3),
                                           seed=seed, maxBins=kw.get("max_bins", 32)),
    "rf": lambda seed, **kw: RandomForestRegressor(numTrees=kw.get("num_trees", 100),
                                                   maxDepth=kw.get("max_depth", 5),
                                                   featureSubsetStrategy=kw.get("feature_subset", "all"),
                                                   seed=seed, maxBins=kw.get("max_bins", 32)),
}
ALIASES = {"xgboost": "gbt", "XGBoost": "gbt", "Random Forest": "rf", "random_forest": "rf"}


def make_estimator(model: str, seed: int = 42, **kw):
    """Model registry (R3): unknown names raise ``ValueError``."""
    name = ALIASES.get(model, model)
    if name not in MODELS:
        raise ValueError(f"model must be one of {sorted(MODELS)} (got {model!r})")
    est = MODELS[name](seed, **kw)
    return est.setFeaturesCol("features").setLabelCol("label").setPredictionCol("prediction")


def training_pairs(obs: DataFrame, features: list[str] | None = None, target: str = REGRESSION_TARGET,
                   mode: str = "lagged") -> DataFrame:
    """One row per (location, origin d) with the feature vector and label.

    ``lagged``: ``x = features(d)``, ``label = target(d + 1)``, ``label_date = d + 1``.
    ``next_day``: training rows are ``(features(j), target(j))`` with ``label_date = j``,
    and origin d is scored with ``features(d + 1)`` (the reference's pairing).
    Next-day values come from a one-day RANGE frame (calendar gaps → null),
    riding the location partitioning — no extra join.
    """
    feats = list(features or REGRESSION_FEATURES)
    missing = [c for c in feats + [target] if c not in obs.columns]
    if missing:  # P12
        raise ValueError(f"columns not in input: {missing}")
    d = obs.withColumns({f"_nx_{c}": day_ahead(f"min(`{c}`)") for c in feats + [target]})
    d = d.withColumn("_nx_exists", day_ahead("count(1)") > 0)
    asm = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    asm_nx = VectorAssembler(inputCols=[f"_nx_{c}" for c in feats], outputCol="features_next",
                             handleInvalid="keep")
    d = asm_nx.transform(asm.transform(d))
    if mode == "lagged":
        d = (d.withColumn("label", F.col(f"_nx_{target}").cast("double"))
              .withColumn("label_date", F.when(F.col("_nx_exists"), F.date_add("date", 1)))
              .withColumn("score_features", F.col("features"))
              .withColumn("scorable", F.lit(True)))
    elif mode == "next_day":
        d = (d.withColumn("label", F.col(target).cast("double"))
              .withColumn("label_date", F.col("date"))
              .withColumn("score_features", F.col("features_next"))
              .withColumn("scorable", F.col("_nx_exists")))
    else:
        raise ValueError("mode must be 'lagged' or 'next_day'")
    return d.drop(*[c for c in d.columns if c.startswith("_nx_")], "features_next")


FILE_ROWS = 1600  # of a file of pairs, at least on average


def stored_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` written whole weeks to a file and sorted by day, and read back.

    Weeks are dealt by a hash: a rerun deals the rows alike, so seeded forests repeat. A fit runs several jobs
    a tree level over these files; so their number follows the pairs (a row per location and day) where the shuffle
    partitions, which follow the tables behind them, are more.
    """
    def by_week(df: DataFrame, files: int) -> DataFrame:
        dealt = df.repartition(files, F.trunc("date", "week")).sortWithinPartitions("date", "location")
        return materialize(dealt, "regression_pairs")

    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = by_week(pairs, n)
    files = max(1, -(-pairs.count() // FILE_ROWS))
    return by_week(pairs, files) if files < n else pairs


def yearly_cutoffs(first: dt.date, last: dt.date) -> list[dt.date]:
    return [dt.date(y, 1, 1) for y in range(first.year + 1, last.year + 1)]


def monthly_cutoffs(first: dt.date, last: dt.date) -> list[dt.date]:
    out, y, m = [], first.year, first.month
    while True:
        m += 1
        if m > 12:
            y, m = y + 1, 1
        d = dt.date(y, m, 1)
        if d > last:
            return out
        out.append(d)


WARM_UP_DAYS = (1, 30, 182)  # refits after the first day, before the first regular one


def with_warm_up(lo: dt.date, cutoffs: list[dt.date]) -> list[dt.date]:
    early = [lo + dt.timedelta(days=n) for n in WARM_UP_DAYS]
    return [d for d in early if not cutoffs or d < cutoffs[0]] + cutoffs


def resolve_cutoffs(obs: DataFrame, refit, span: tuple | None = None) -> list[dt.date]:
    """Cutoff days from ``refit``: ``"year"``, ``"month"``, ``"day"`` or an explicit list.

    Only the table's first and last day reach the driver (one 2-value aggregate,
    skipped when ``span`` already holds them).
    """
    if isinstance(refit, (list, tuple)):
        return sorted(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in refit)
    lo, hi = span if span is not None else obs.agg(F.min("date"), F.max("date")).first()
    if lo is None:
        return []
    if refit == "year":
        return with_warm_up(lo, yearly_cutoffs(lo, hi))
    if refit == "month":
        return with_warm_up(lo, monthly_cutoffs(lo, hi))
    if refit == "day":
        return [lo + dt.timedelta(days=n) for n in range(1, (hi - lo).days + 1)]
    raise ValueError("refit must be 'year', 'month', 'day' or a list of dates")


def rolling_regression(obs: DataFrame, model: str = "rf", refit="year", mode: str = "lagged",
                       features: list[str] | None = None, target: str = REGRESSION_TARGET,
                       model_version: str | None = None, parallelism: int = 4, seed: int = 42,
                       missing: str = "null", model_dir: str | None = None,
                       per_location: list[str] | None = None, **params) -> DataFrame:
    """Predictions of ``target`` for day d + 1 at every (location, origin d).

    Output columns follow the prediction table: location, date (origin),
    target_date, ``{target}_predicted``, the day's actuals, model_version,
    model_cutoff, fit_error. ``missing="zero"`` gives 0 where the reference did (no
    next-day row, or a NaN); by default those are null. Without a model: null.

    ``per_location``: an explicit list of locations, each with its own models
    (the reference trains per location over a literal list). Output is then
    limited to those locations; fits = locations × cutoffs, run from the same
    thread pool. The pooled default trains one model per cutoff for all.
    """
    make_estimator(model, seed, **params)  # validate the name before any work (R3)
    version = model_version or f"{ALIASES.get(model, model)}_v1"
    spark = obs.sparkSession
    if per_location is not None:
        obs = obs.filter(F.col("location").isin(list(per_location)))
    pairs = stored_pairs(training_pairs(obs, features, target, mode))
    cutoffs = resolve_cutoffs(pairs, refit)
    bounds = list(zip(cutoffs, cutoffs[1:] + [None]))

    groups = list(per_location) if per_location is not None else [None]
    tasks = [(loc, None, cutoffs[0] if cutoffs else None) for loc in groups]  # origins before any model
    tasks += [(loc, c, nxt) for loc in groups for c, nxt in bounds]
    carried = ["location", "date", "new_cases", "new_deaths", "new_vaccinations", "total_cases",
               "total_deaths", "life_expectancy", "excess_mortality"]
    carried = [c for c in carried if c in pairs.columns]
    scored = scratch_path(spark, "regression_scores")

    def scope(df: DataFrame, loc) -> DataFrame:
        return df if loc is None else df.filter(F.col("location") == loc)

    def fit(loc, c):
        train = scope(pairs, loc).filter((F.col("label_date") <= F.lit(c)) & F.col("label").isNotNull())
        # label days are origins' days or the next ones: prunes the scan by the sorted day
        m = make_estimator(model, seed, **params).fit(train.filter(F.col("date") <= F.lit(c)))
        if model_dir:
            from trendlake.sinks.tables import save_model
            save_model(m, model_dir, version, loc, c)
        return m

    def run(numbered) -> None:
        number, (loc, c, nxt) = numbered
        seg = scope(pairs, loc)
        if c is not None:
            seg = seg.filter(F.col("date") >= F.lit(c))
        if nxt is not None:
            seg = seg.filter(F.col("date") < F.lit(nxt))
        m, error = None, None
        if c is not None:
            try:
                m = fit(loc, c)
            except Exception as e:  # noqa: BLE001 - R4: a failed fit is reported, the run goes on
                error = f"{type(e).__name__}: {e}"[:300]
                log.warning("fit for %s at cutoff %s failed: %s", loc or "all", c, error)
        if m is not None:
            seg = m.setFeaturesCol("score_features").transform(seg)
        else:
            seg = seg.withColumn("prediction", F.lit(None).cast("double"))
        seg = seg.select(*carried, "scorable", "prediction", F.lit(c).cast("date").alias("model_cutoff"),
                         F.lit(error).cast("string").alias("fit_error"))
        seg.write.parquet(f"{scored}/task={number}")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(run, enumerate(tasks)))

    schema = pairs.select(*carried, "scorable", F.lit(0.0).alias("prediction"),
                          F.lit(None).cast("date").alias("model_cutoff"),
                          F.lit(None).cast("string").alias("fit_error")).schema
    out = spark.read.schema(schema).parquet(scored)
    pred = F.when(F.col("scorable"), F.col("prediction"))
    if missing == "zero":
        pred = F.when(~F.col("scorable") | F.isnan("prediction"), F.lit(0.0)).otherwise(F.col("prediction"))
    return out.select(
        "location", "date", F.date_add("date", 1).alias("target_date"),
        pred.alias(f"{target}_predicted"),
        *[F.col(c).alias(f"{c}_actual") for c in ("new_cases", "new_deaths", "new_vaccinations") if c in carried],
        *[c for c in ("total_cases", "total_deaths", "life_expectancy", "excess_mortality") if c in carried],
        F.lit(version).alias("model_version"), "model_cutoff", "fit_error")
