"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver's tables (or data Spark derives from them), so its
work grows with them. Computed floating columns are rounded to 6 decimals so the
cross-engine check (DuckDB) compares values, not last-bit summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators import evaluate as ev
from trendlake.operators import forecast as fc
from trendlake.sources.tables import observations

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


@register("daily_series")
def q_daily_series(spark, sf_dir):
    """The derived observation table (12-field OBS schema)."""
    obs = observations(spark, sf_dir)
    return _round(obs, ["life_expectancy", "excess_mortality"])


@register("forecast_cases")
def q_forecast_cases(spark, sf_dir):
    """W2 one-day-ahead new_cases forecast for every (location, origin day)."""
    out = fc.forecast(observations(spark, sf_dir), target="new_cases")
    return _round(out, ["new_cases_predicted"])


@register("forecast_deaths")
def q_forecast_deaths(spark, sf_dir):
    out = fc.forecast(observations(spark, sf_dir), target="new_deaths")
    return _round(out, ["new_deaths_predicted"])


def _eval(spark, sf_dir, align: str) -> DataFrame:
    f = fc.forecast_with_actuals(observations(spark, sf_dir), "new_cases", align=align)
    m = ev.metrics(f, "new_cases_actual", "new_cases_predicted", by=["location", "model_version"])
    return _round(m.withColumn("target", F.lit("new_cases")), ["rmse", "mae", "r2"])


@register("forecast_eval_target")
def q_forecast_eval_target(spark, sf_dir):
    """RMSE/MAE/R² by location, forecast for d+1 judged against the actual of d+1."""
    return _eval(spark, sf_dir, "target")


@register("forecast_eval_origin")
def q_forecast_eval_origin(spark, sf_dir):
    """Same, judged against the actual of the origin day (the reference's pairing)."""
    return _eval(spark, sf_dir, "origin")


# ------------------------------------------------------------------ helpers
def _round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    from pyspark.sql import types as T
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, T.DoubleType)})


def w2_predictions(spark, sf_dir) -> DataFrame:
    """Prediction table of the windowed forecast (all 3 targets), reference row form."""
    from trendlake.plans.jobs import forecast_predictions
    return forecast_predictions(observations(spark, sf_dir))


def events(spark, sf_dir) -> DataFrame:
    from trendlake.sources.tables import table
    return table(spark, sf_dir, "events")


PRED_NUMERIC = ["new_cases_predicted", "new_deaths_predicted", "new_vaccinations_predicted",
                "new_cases_actual", "new_deaths_actual", "new_vaccinations_actual",
                "total_cases", "total_deaths", "life_expectancy", "excess_mortality"]


# ---------------------------------------------------------- prep operators
@register("fill_nulls")
def q_fill_nulls(spark, sf_dir):
    """Nulls → 0 in numeric columns, strings untouched."""
    from trendlake.operators.prep import fill_nulls
    return _round_doubles(fill_nulls(observations(spark, sf_dir)))


@register("next_day_join")
def q_next_day_join(spark, sf_dir):
    """Each row with the next calendar day's new_cases / new_deaths (null across gaps)."""
    from trendlake.operators.prep import next_day
    d = next_day(observations(spark, sf_dir), ["new_cases", "new_deaths"])
    return d.select("location", "date", "new_cases", "next_exists", "next_new_cases", "next_new_deaths")


@register("predictions_w2")
def q_predictions_w2(spark, sf_dir):
    """The backtest's prediction table for the windowed model (one pass, 3 targets).

    ``created_at`` is stamped by the sink at write time and the windowed model has
    no training cutoff, so both always-null columns are left out here.
    """
    return _round_doubles(w2_predictions(spark, sf_dir).drop("created_at", "model_cutoff"))


@register("eval_by_model")
def q_eval_by_model(spark, sf_dir):
    """A4: RMSE/MAE/R² per (model_version, target) over all locations, target-aligned."""
    return _round_doubles(ev.evaluate(w2_predictions(spark, sf_dir), by=["model_version"]))


@register("eval_by_location_origin")
def q_eval_by_location_origin(spark, sf_dir):
    """A4 with the reference's same-day pairing, per (location, model_version, target)."""
    return _round_doubles(ev.evaluate(w2_predictions(spark, sf_dir), by=["location", "model_version"],
                                      align="origin"))


@register("error_series")
def q_error_series(spark, sf_dir):
    """Predicted − actual per (location, origin), actual of the target day."""
    p = ev.error_columns(ev.align_to_target(w2_predictions(spark, sf_dir)))
    return _round_doubles(p.select("location", "date", "model_version", "cases_error", "deaths_error"))


# --------------------------------------------------------- explore operators
@register("locations")
def q_locations(spark, sf_dir):
    from trendlake.operators.explore import locations
    return locations(w2_predictions(spark, sf_dir))


@register("describe_predictions")
def q_describe(spark, sf_dir):
    from trendlake.operators.explore import describe
    return _round_doubles(describe(w2_predictions(spark, sf_dir), PRED_NUMERIC))


@register("location_stats")
def q_location_stats(spark, sf_dir):
    from trendlake.operators.explore import location_stats
    return _round_doubles(location_stats(w2_predictions(spark, sf_dir)))


@register("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    from trendlake.operators.explore import corr_matrix
    from trendlake.schema import CORR_COLUMNS
    return _round_doubles(corr_matrix(w2_predictions(spark, sf_dir), CORR_COLUMNS))


@register("compare_locations")
def q_compare_locations(spark, sf_dir):
    """One metric by date with location as hue."""
    from trendlake.operators.explore import mean_ci
    return _round_doubles(mean_ci(w2_predictions(spark, sf_dir), "date", "excess_mortality", "location"))


@register("mean_ci_by_date")
def q_mean_ci_by_date(spark, sf_dir):
    """Mean event value per (day, event_type) with a 95 % interval."""
    from trendlake.operators.explore import mean_ci
    e = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return _round_doubles(mean_ci(e, "day", "value", "event_type"))


@register("bar_by_segment")
def q_bar_by_segment(spark, sf_dir):
    """Mean account balance per market segment with a 95 % interval."""
    from trendlake.operators.explore import mean_ci
    from trendlake.sources.tables import table
    return _round_doubles(mean_ci(table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal"))


@register("hist_events")
def q_hist_events(spark, sf_dir):
    """A10: histogram of event values per event_type on shared 'auto' bins."""
    from trendlake.operators.explore import histogram
    return _round_doubles(histogram(events(spark, sf_dir), "value", "event_type"))


@register("hist_errors")
def q_hist_errors(spark, sf_dir):
    """Distribution of the cases forecast error (20 bins)."""
    from trendlake.operators.explore import histogram
    p = ev.error_columns(ev.align_to_target(w2_predictions(spark, sf_dir)))
    return _round_doubles(histogram(p, "cases_error", bins=20))


@register("kde_events")
def q_kde_events(spark, sf_dir):
    """Gaussian density of event values per event_type on a 200-point grid."""
    from trendlake.operators.explore import kde
    return _round_doubles(kde(events(spark, sf_dir), "value", "event_type"))


@register("box_events")
def q_box_events(spark, sf_dir):
    """Box statistics of event values per event_type."""
    from trendlake.operators.explore import box_stats
    return _round_doubles(box_stats(events(spark, sf_dir), "value", ["event_type"]))


@register("violin_events")
def q_violin_events(spark, sf_dir):
    """Density per event_type with its quartiles."""
    from trendlake.operators.explore import violin
    return _round_doubles(violin(events(spark, sf_dir), "value", ["event_type"]))


@register("metric_series")
def q_metric_series(spark, sf_dir):
    """Tall (location, date, metric, label, value) series of the dashboard metrics."""
    from trendlake.operators.explore import series_tall
    m = ["new_cases_actual", "new_deaths_actual", "total_cases", "total_deaths",
         "new_vaccinations_actual", "excess_mortality"]
    return _round_doubles(series_tall(w2_predictions(spark, sf_dir), m))


@register("area_series")
def q_area_series(spark, sf_dir):
    """Sorted (location, date, total_cases) area data."""
    from trendlake.operators.explore import area_series
    return area_series(w2_predictions(spark, sf_dir), "date", "total_cases", "location")


# ------------------------------------------------------ ingest, sources, sinks
def _scratch(spark, name: str) -> str:
    from trendlake.session import scratch_path
    return scratch_path(spark, name)


@register("parse_messages")
def q_parse_messages(spark, sf_dir):
    """Every observation encoded as a JSON message and parsed back."""
    from trendlake.streaming.ingest import encode, parse
    parsed = parse(encode(observations(spark, sf_dir)), keep_corrupt=False)
    return _round_doubles(parsed)


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Messages landed as files (one per partition of the data), drained
    by a rate-capped availableNow stream into month-partitioned parquet, then read back."""
    from trendlake.sinks.tables import publish_messages
    from trendlake.streaming.ingest import await_all, read_observations, run_stream, text_source
    base = _scratch(spark, "stream_ingest")
    publish_messages(observations(spark, sf_dir), f"{base}/landing")
    qs = run_stream(text_source(spark, f"{base}/landing", max_files_per_trigger=1000),
                    f"{base}/table", f"{base}/checkpoint", "stream_ingest_" + base.rsplit("/", 1)[-1][:8],
                    quarantine_path=f"{base}/quarantine", keep_bad=False)
    await_all(qs)
    return _round_doubles(read_observations(spark, f"{base}/table"))


def _ingest(spark, base: str, name: str, **kw) -> None:
    """One run of the ingest command with its default checkpoint."""
    from trendlake.streaming.ingest import await_all, default_checkpoint, run_stream, text_source
    await_all(run_stream(text_source(spark, f"{base}/landing"), f"{base}/table",
                         default_checkpoint(f"{base}/table", name), name, **kw))


@register("stream_ingest_twice")
def q_stream_ingest_twice(spark, sf_dir):
    """Odd days landed and ingested, then even days landed and ingested in a second
    run with the same settings, with and without a quarantine; every row once in each table."""
    from trendlake.sinks.tables import publish_messages
    from trendlake.streaming.ingest import read_observations
    obs = observations(spark, sf_dir)
    out = None
    for mode in ("plain", "quarantine"):
        base = _scratch(spark, f"stream_twice_{mode}")
        kw = {"quarantine_path": f"{base}/quarantine", "keep_bad": False} if mode == "quarantine" else {}
        for half in (1, 0):
            publish_messages(obs.filter(F.dayofmonth("date") % 2 == half), f"{base}/landing")
            _ingest(spark, base, "ingest", **kw)
        got = read_observations(spark, f"{base}/table").withColumn("mode", F.lit(mode))
        out = got if out is None else out.unionByName(got)
    return _round_doubles(out)


@register("stream_ingest_malformed")
def q_stream_ingest_malformed(spark, sf_dir):
    """Messages of the 1st of a month cut short (not JSON), of the 2nd with a wrong-typed
    field, of the 3rd with a bad date. Rows with location and date stay (the field null); every
    malformed message is quarantined."""
    from trendlake.streaming.ingest import encode, read_observations
    base = _scratch(spark, "stream_malformed")
    obs = observations(spark, sf_dir)
    whole = encode(obs.filter(F.dayofmonth("date") > 3))
    cut = encode(obs.filter(F.dayofmonth("date") == 1)).select(F.substring("value", 1, 20).alias("value"))
    typed = encode(obs.filter(F.dayofmonth("date") == 2)).select(
        F.regexp_replace("value", '"new_cases":[^,}]*', '"new_cases":"many"').alias("value"))
    dated = encode(obs.filter(F.dayofmonth("date") == 3)).select(
        F.regexp_replace("value", '"date":"[^"]*"', '"date":"someday"').alias("value"))
    whole.union(cut).union(typed).union(dated).write.text(f"{base}/landing")
    _ingest(spark, base, "ingest", quarantine_path=f"{base}/quarantine", keep_bad=False)
    good = read_observations(spark, f"{base}/table").select("location", "date", "new_cases", "total_cases")
    bad = spark.read.parquet(f"{base}/quarantine").groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    return (_round_doubles(good).withColumns({"store": F.lit("table"), "n": F.lit(1).cast("bigint")})
            .unionByName(bad.select("location", F.lit(None).cast("date").alias("date"),
                                    F.lit(None).cast("double").alias("new_cases"),
                                    F.lit(None).cast("double").alias("total_cases"),
                                    F.lit("quarantine").alias("store"), "n")))


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Observations written as CSV with a header and read back with the wire schema."""
    from trendlake.sources.files import read_csv, to_observations
    base = _scratch(spark, "csv")
    observations(spark, sf_dir).write.option("header", "true").csv(f"{base}/obs")
    return _round_doubles(to_observations(read_csv(spark, f"{base}/obs")))


@register("predictions_store")
def q_predictions_store(spark, sf_dir):
    """The prediction table written twice (a rerun) and read back once."""
    from trendlake.sinks.tables import read_predictions, write_predictions
    base = _scratch(spark, "predictions")
    pred = w2_predictions(spark, sf_dir)
    write_predictions(pred, base)
    write_predictions(pred, base)
    out = read_predictions(spark, base).drop("created_at", "model_cutoff")
    return _round_doubles(out)


@register("predictions_store_by_location")
def q_predictions_store_by_location(spark, sf_dir):
    """The backtest of one group of locations, then of another, then of the first again, each
    written in its own run: every location's series is there once."""
    from trendlake.sinks.tables import read_predictions, write_predictions
    base = _scratch(spark, "predictions_by_location")
    pred = w2_predictions(spark, sf_dir)
    early = F.col("location") < "J"
    for part in (early, ~early, early):
        write_predictions(pred.filter(part), base)
    return _round_doubles(read_predictions(spark, base, dedup=False).drop("created_at", "model_cutoff"))


# -------------------------------------------------------------- regressions
def _regression(spark, sf_dir, model: str, **kw) -> DataFrame:
    from trendlake.operators.regress import rolling_regression
    from trendlake.plans.jobs import prepped
    out = rolling_regression(prepped(observations(spark, sf_dir)), model=model, **kw)
    return _round_doubles(out)


@register("rf_deaths")
def q_rf_deaths(spark, sf_dir):
    """R2: random forest (100 trees, seed 42) of next-day deaths, yearly refits."""
    return _regression(spark, sf_dir, "rf")


@register("gbt_deaths")
def q_gbt_deaths(spark, sf_dir):
    """Boosted trees (100 rounds, squared loss, seed 42) of next-day deaths, yearly refits."""
    return _regression(spark, sf_dir, "gbt")


@register("rf_deaths_frame")
def q_rf_deaths_frame(spark, sf_dir):
    """What SQL can state of the forest's backtest — each origin's target day, model cutoff,
    actuals, and whether it has a prediction (a small forest: the values are not compared)."""
    from trendlake.operators.regress import rolling_regression
    from trendlake.plans.jobs import prepped
    out = rolling_regression(prepped(observations(spark, sf_dir)), "rf", num_trees=3)
    return out.select("location", "date", "target_date", "model_cutoff", "new_cases_actual", "new_deaths_actual",
                      F.col("new_deaths_predicted").isNotNull().alias("predicted"))


@register("forecast_pooled")
def q_forecast_pooled(spark, sf_dir):
    """W2 in the pooled 'all' mode (Q7): one series over every location's rows, scored per row."""
    out = fc.forecast(observations(spark, sf_dir), target="new_cases", partition=[])
    return _round(out, ["new_cases_predicted"])


@register("predictions_reference_mode")
def q_predictions_reference_mode(spark, sf_dir):
    """The reference's stored row — cases forecast with failures as 0,
    vaccinations the constant 0, no deaths model."""
    from trendlake.plans.jobs import forecast_predictions
    out = forecast_predictions(observations(spark, sf_dir), reference_mode=True)
    return _round_doubles(out.drop("created_at", "model_cutoff"))


@register("rf_deaths_reference_mode")
def q_rf_deaths_reference_mode(spark, sf_dir):
    """R2 with the reference's pairing (Q4/Q5): trained on same-day features, scored with
    the next day's features, 0 when the next day is missing or no model exists yet."""
    return _regression(spark, sf_dir, "rf", mode="next_day", missing="zero")


@register("backtest_combined")
def q_backtest_combined(spark, sf_dir):
    """W3 in the reference's output form: one combined_model_v1 row per (location, origin)
    with the windowed cases forecast and the random-forest deaths forecast."""
    from trendlake.plans.jobs import backtest
    out = backtest(observations(spark, sf_dir), models=("rf",), combine=True)
    return _round_doubles(out.drop("created_at"))


@register("forecast_cases_yearly")
def q_forecast_cases_yearly(spark, sf_dir):
    """W2 with the month-of-year term added to the weekly one."""
    out = fc.forecast(observations(spark, sf_dir), target="new_cases", seasonality=("weekly", "yearly"))
    return _round(out, ["new_cases_predicted"])


@register("eval_reference_mode")
def q_eval_reference_mode(spark, sf_dir):
    """A4 as the reference's dashboard computes it: its stored rows, same-day pairing,
    all locations per model version (targets without complete pairs have no row)."""
    from trendlake.plans.jobs import forecast_predictions
    pred = forecast_predictions(observations(spark, sf_dir), reference_mode=True)
    return _round_doubles(ev.evaluate(pred, by=["model_version"], align="origin"))



# ------------------------------------------------------------- dashboard analyses
@register("filter_location")
def q_filter_location(spark, sf_dir):
    """The observations of some locations."""
    from trendlake.operators.prep import filter_locations
    d = filter_locations(observations(spark, sf_dir), ["CANADA", "MOROCCO", "NATION_0", "NATION_1"])
    return _round_doubles(d.select("location", "date", "new_cases"))


@register("actual_vs_predicted")
def q_actual_vs_predicted(spark, sf_dir):
    """Complete (actual, predicted) pairs of the location with the smallest name, every model."""
    from trendlake.operators.explore import locations
    p = w2_predictions(spark, sf_dir)
    first = locations(p).first()[0]
    return _round_doubles(ev.actual_vs_predicted(p, first))


@register("describe_dates")
def q_describe_dates(spark, sf_dir):
    """The date part of describe()."""
    from trendlake.operators.explore import describe_dates
    d = describe_dates(w2_predictions(spark, sf_dir), ["date", "target_date"])
    return d.select("metric", "count", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
                                         for c in ("min", "q25", "q50", "q75", "max")])


@register("compare_metric")
def q_compare_metric(spark, sf_dir):
    """D3: one of the six metrics by date and location with its label."""
    from trendlake.plans.analyze import compare
    return _round_doubles(compare(w2_predictions(spark, sf_dir), "excess_mortality").select(
        "date", "location", "n", "mean", "label"))


@register("error_distribution")
def q_error_distribution(spark, sf_dir):
    """The density of the cases error, from the error analysis."""
    from trendlake.plans.analyze import error_analysis
    return _round_doubles(error_analysis(w2_predictions(spark, sf_dir))["cases_error_kde"])


@register("chart_histogram_kde")
def q_chart_histogram_kde(spark, sf_dir):
    """The interactive histogram: bars, and the density curve scaled to counts."""
    from trendlake.plans.analyze import chart_data
    d = chart_data(events(spark, sf_dir), "histogram", "value", color="event_type")
    return _round_doubles(d.drop("category"))


@register("analyze_predictions")
def q_analyze_predictions(spark, sf_dir):
    """The metrics table of the predictions analysis, shown with two decimals."""
    from trendlake.plans.analyze import analyze
    d = analyze(w2_predictions(spark, sf_dir), "predictions")["metrics_by_location"]
    return _round_doubles(d, 4)


@register("forecast_fourier")
def q_forecast_fourier(spark, sf_dir):
    """W2 with trend changes and Fourier seasons: one ridge fit per (location, origin) from running sums."""
    from trendlake.operators.fourier import forecast_fourier
    return _round(forecast_fourier(observations(spark, sf_dir)), ["new_cases_predicted"], 4)


@register("rf_deaths_daily")
def q_rf_deaths_daily(spark, sf_dir):
    """The forest (100 trees) with leaf values of every origin's own day, structures of yearly cutoffs."""
    from trendlake.operators.leaf_refresh import daily_forest
    from trendlake.plans.jobs import prepped
    return _round_doubles(daily_forest(prepped(observations(spark, sf_dir))))


@register("regression_beats_mean")
def q_regression_beats_mean(spark, sf_dir):
    """Next-day total_deaths (new_deaths has nothing to learn in these tables): judged origins, the running
    mean's RMSE, and whether each learner's is lower: forest, forest with daily values, boosted trees (20 rounds, 2 fits)."""
    import datetime as dt

    from trendlake.operators.leaf_refresh import beats_mean, daily_forest
    from trendlake.operators.regress import rolling_regression
    from trendlake.plans.jobs import prepped
    obs = prepped(observations(spark, sf_dir))
    fits = [dt.date(y, 1, 1) for y in BOOSTED_CUTOFF_YEARS]
    found = (rolling_regression(obs, "rf", target="total_deaths")
             .unionByName(daily_forest(obs, target="total_deaths"))
             .unionByName(rolling_regression(obs, "gbt", target="total_deaths", refit=fits, max_iter=20)))
    return _round_doubles(beats_mean(found, obs, "total_deaths").drop("rmse"))


BOOSTED_CUTOFF_YEARS = (1997, 1999)


@register("kde_balance")
def q_kde_balance(spark, sf_dir):
    """A11 on a continuous column: density of account balances per market segment."""
    from trendlake.operators.explore import kde
    from trendlake.sources.tables import table
    d = kde(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment")
    return _round_doubles(d.withColumn("density", F.col("density") * 1e6)).withColumnRenamed("density", "density_per_million")


@register("kde_balance_binned")
def q_kde_balance_binned(spark, sf_dir):
    """A11 for continuous data at scale: "auto" bins; the largest distance from the exact curve, as a share of
    the proved bound, is at most 1 in every segment."""
    from trendlake.operators.explore import FINE, kde
    from trendlake.sources.tables import table
    d = table(spark, sf_dir, "customer")
    exact = kde(d, "c_acctbal", "c_mktsegment")
    binned = kde(d, "c_acctbal", "c_mktsegment", bins="auto").select("c_mktsegment", "grid", F.col("density").alias("binned"))
    bound = 0.4 / (8 * FINE * FINE * F.col("bandwidth"))
    both = exact.join(binned, ["c_mktsegment", "grid"])
    return _round_doubles(both.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("points"), F.max("bandwidth").alias("bandwidth"),
                                                           (F.max(F.abs(F.col("density") - F.col("binned")) / bound) <= 1).alias("within")))


@register("stream_compacted")
def q_stream_compacted(spark, sf_dir):
    """Three landings and runs; closed months compacted after the second, and again after the third, which
    brought late days of months already compacted. The table is the series, every row once."""
    import datetime as dt

    from trendlake.sinks.tables import publish_messages
    from trendlake.streaming.compaction import compact
    from trendlake.streaming.ingest import default_checkpoint, read_observations
    base = _scratch(spark, "stream_compacted")
    obs = observations(spark, sf_dir)
    for part, cutoff in ((0, None), (1, dt.date(1997, 1, 1)), (2, dt.date(2000, 6, 1))):
        publish_messages(obs.filter(F.dayofmonth("date") % 3 == part), f"{base}/landing")
        _ingest(spark, base, "ingest")
        if cutoff:
            compact(spark, f"{base}/table", [default_checkpoint(f"{base}/table", "ingest")], cutoff)
    return _round_doubles(read_observations(spark, f"{base}/table"))


@register("publish_report")
def q_publish_report(spark, sf_dir):
    """Rows made bad (no location, no date, an infinite number): what was sent and what failed, by reason, from
    the files, beside the counts observed in the pass that wrote them."""
    from trendlake.sinks.tables import publish_report
    day = F.dayofmonth("date")
    obs = observations(spark, sf_dir).withColumn("_day", day)
    bad = obs.withColumns({"location": F.when(F.col("_day") != 1, F.col("location")), "date": F.when(F.col("_day") != 2, F.col("date")),
                           "new_cases": F.when(F.col("_day") == 3, F.lit(float("inf"))).otherwise(F.col("new_cases"))}).drop("_day")
    told = publish_report(bad, _scratch(spark, "publish_report"))
    sent = spark.read.text(f"{told['run']}/status=sent").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("sent").alias("status"), F.lit(None).cast("string").alias("reason"), "n")
    failed = spark.read.text(f"{told['run']}/status=failed").groupBy(F.get_json_object("value", "$.reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("failed").alias("status"), "reason", "n")
    return sent.unionByName(failed).withColumn("observed", F.when(F.col("status") == "sent", told["sent"]).otherwise(told["failed"]))


@register("metrics_state")
def q_metrics_state(spark, sf_dir):
    """Metrics by model, by location and by month from the state of two increments, the second written twice."""
    from trendlake.operators.metric_state import read_state, scoped_metrics, write_increment
    from trendlake.session import materialize
    path = _scratch(spark, "metric_state")
    pairs = materialize(ev.align_to_target(w2_predictions(spark, sf_dir)), "judged_pairs")
    for name, part in (("early", F.col("date") < "1998-07-15"), ("late", F.col("date") >= "1998-07-15"), ("late", F.col("date") >= "1998-07-15")):
        write_increment(pairs.filter(part), path, name)
    return _round_doubles(scoped_metrics(read_state(spark, path)))


@register("stream_replay")
def q_stream_replay(spark, sf_dir):
    """Everything lands twice, the second time in another order and split over two runs, each run merged by
    (location, date) into the months it touches: every row once."""
    import datetime as dt

    from trendlake.sinks.tables import publish_messages
    from trendlake.streaming.compaction import compact
    from trendlake.streaming.ingest import default_checkpoint, read_observations
    base = _scratch(spark, "stream_replay")
    obs = observations(spark, sf_dir)
    again = obs.repartition(4, "date")
    for part in (obs, again.filter(F.month("date") > 6), again.filter(F.month("date") <= 6)):
        publish_messages(part, f"{base}/landing")
        _ingest(spark, base, "ingest")
        compact(spark, f"{base}/table", [default_checkpoint(f"{base}/table", "ingest")], dt.date(2100, 1, 1), keys=["location", "date"])
    return _round_doubles(read_observations(spark, f"{base}/table"))
