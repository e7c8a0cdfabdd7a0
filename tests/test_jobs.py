"""Backtest, sinks, regressions and the analysis façade."""

import pytest
from pyspark.sql import functions as F

from trendlake.plans import analyze as an
from trendlake.plans import jobs
from trendlake.sinks import tables as sk
from trendlake.sources import kafka
from trendlake.sources.tables import observations

SF = "/root/testdata/sf0.001"


def test_rerun_is_idempotent(spark, tmp_dir):
    pred = jobs.forecast_predictions(observations(spark, SF))
    n = pred.count()
    sk.write_predictions(pred, tmp_dir)
    sk.write_predictions(pred, tmp_dir)
    assert sk.read_predictions(spark, tmp_dir).count() == n
    assert sk.read_predictions(spark, tmp_dir, dedup=False).count() == n


def test_missing_predictions_table_is_empty(spark, tmp_dir):
    assert sk.read_predictions(spark, f"{tmp_dir}/nope").count() == 0


def test_reference_mode_row(spark):
    pred = jobs.forecast_predictions(observations(spark, SF), reference_mode=True)
    r = pred.agg(F.min("new_vaccinations_predicted"), F.max("new_vaccinations_predicted"),
                 F.count(F.when(F.col("new_cases_predicted").isNull(), 1))).first()
    assert r[0] == 0.0 and r[1] == 0.0 and r[2] == 0


def test_regression_deterministic_and_no_lookahead(spark):
    from trendlake.operators.regress import rolling_regression
    obs = jobs.prepped(observations(spark, "/root/testdata/sf0.01"))
    kw = dict(model="rf", num_trees=5, max_depth=4, refit=["1996-01-01", "1998-01-01"])
    a = rolling_regression(obs, **kw)
    b = rolling_regression(obs, **kw)
    assert a.exceptAll(b).count() == 0
    assert a.filter(F.col("model_cutoff") > F.col("date")).count() == 0
    assert a.filter(F.col("date") < "1996-01-01").agg(F.count("new_deaths_predicted")).first()[0] == 0


def test_regression_beats_mean_on_linear_data(spark):
    import datetime as dt
    from trendlake.operators.regress import rolling_regression
    rows = []
    for loc in ("A", "B"):
        for i in range(400):
            x = float(i % 37)
            rows.append((loc, dt.date(2019, 1, 1) + dt.timedelta(days=i), x, 2.0 * x + 1.0))
    df = spark.createDataFrame(rows, "location string, date date, new_cases double, new_deaths double")
    out = rolling_regression(df, model="gbt", features=["new_cases"], mode="next_day", max_iter=10,
                             refit=["2019-07-01"])
    scored = out.filter(F.col("new_deaths_predicted").isNotNull())
    j = scored.alias("p").join(df.alias("o"), (F.col("p.location") == F.col("o.location"))
                               & (F.col("o.date") == F.col("p.target_date")))
    err = j.agg(F.avg(F.abs(F.col("o.new_deaths") - F.col("p.new_deaths_predicted")))).first()[0]
    assert err < 2.0  # mean predictor's error is ~18


def test_backtest_combined(spark):
    obs = observations(spark, "/root/testdata/sf0.01")
    out = jobs.backtest(obs, models=("rf",), combine=True,
                        regress_kwargs=dict(num_trees=3, max_depth=3, refit=["1997-01-01"]))
    assert out.select("model_version").distinct().first()[0] == "combined_model_v1"
    assert out.count() == obs.count()


def test_backtest_stack(spark):
    obs = observations(spark, SF)
    out = jobs.backtest(obs, models=("trend_dow", "rf"), regress_kwargs=dict(num_trees=2, max_depth=2))
    assert out.groupBy("model_version").count().count() == 2
    with pytest.raises(ValueError):
        jobs.backtest(obs, models=("svm",))


def test_analyze_facade(spark):
    pred = jobs.forecast_predictions(observations(spark, SF))
    loc = pred.select("location").first()[0]
    p = an.analyze(pred, "predictions", location=loc)
    assert p["metrics_all_locations"].count() == 3
    assert p["cases_series"].count() > 0
    for kind in ("data_analysis", "error_analysis", "summary_statistics"):
        for name, df in an.analyze(pred, kind, location=loc, filter_location=True).items():
            df.count()
    for chart in ("scatter", "line", "bar", "histogram", "box", "area", "violin"):
        an.analyze(pred, "interactive", chart=chart, x="location", y="new_cases_actual")["chart"].count()
    with pytest.raises(ValueError):
        an.compare(pred, "nope")
    with pytest.raises(ValueError):
        an.analyze(pred, "nope")


def test_kafka_options():
    o = kafka.source_options("h:9092", "topic", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "topic" and o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "1000"
    assert kafka.sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


def test_model_save(spark, tmp_dir):
    from trendlake.operators.regress import rolling_regression
    obs = jobs.prepped(observations(spark, "/root/testdata/sf0.01"))
    rolling_regression(obs, model="rf", num_trees=2, max_depth=2, refit=["1997-01-01"], model_dir=tmp_dir).count()
    import os
    names = os.listdir(tmp_dir)
    assert names == ["rf_v1_all_1997-01-01"]
    assert {"metadata", "data"} <= set(os.listdir(os.path.join(tmp_dir, names[0])))


def test_per_location_models(spark, tmp_dir):
    import os

    from trendlake.operators.regress import rolling_regression
    obs = jobs.prepped(observations(spark, "/root/testdata/sf0.01"))
    locs = [r.location for r in obs.select("location").distinct().orderBy("location").limit(2).collect()]
    out = rolling_regression(obs, model="rf", num_trees=3, max_depth=3, refit=["1997-01-01", "1998-01-01"],
                             per_location=locs, model_dir=tmp_dir)
    assert sorted(r.location for r in out.select("location").distinct().collect()) == locs
    assert out.count() == obs.filter(F.col("location").isin(locs)).count()
    assert len(os.listdir(tmp_dir)) == 4


def test_dedup_keeps_newest(spark):
    import datetime as dt

    from trendlake.operators.prep import dedup_latest
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("A", d, "m", 1.0, dt.date(2020, 1, 5)), ("A", d, "m", 2.0, dt.date(2020, 1, 9)),
                                ("A", d, "n", 3.0, None)],
                               "location string, date date, model_version string, v double, created_at date")
    got = {r.model_version: r.v for r in dedup_latest(df, sk.NATURAL_KEY, [F.col("created_at").desc_nulls_last()]).collect()}
    assert got == {"m": 2.0, "n": 3.0}


def test_evaluate_union_equals_parts(spark):
    from trendlake.operators import evaluate as ev
    pred = jobs.forecast_predictions(observations(spark, SF))
    other = pred.withColumn("model_version", F.lit("copy_v1"))
    both = ev.evaluate(pred.unionByName(other))
    one = ev.evaluate(pred)
    a = {(r.target, r.n, round(r.rmse, 9)) for r in both.filter("model_version = 'copy_v1'").collect()}
    b = {(r.target, r.n, round(r.rmse, 9)) for r in one.collect()}
    assert a == b


def test_cli_end_to_end(spark, tmp_dir):
    """publish CSV → ingest stream → backtest → analyze, through the command line."""
    from trendlake.__main__ import main
    obs = observations(spark, SF)
    obs.write.option("header", "true").csv(f"{tmp_dir}/csv")
    assert main(["publish", "--csv", f"{tmp_dir}/csv", "--landing", f"{tmp_dir}/landing"]) == 0
    assert main(["ingest", "--landing", f"{tmp_dir}/landing", "--table", f"{tmp_dir}/table",
                 "--quarantine", f"{tmp_dir}/bad", "--checkpoint", f"{tmp_dir}/ckpt", "--name", "cli_t"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/table").count() == obs.count()
    assert main(["backtest", "--table", f"{tmp_dir}/table", "--predictions", f"{tmp_dir}/pred",
                 "--models-dir", f"{tmp_dir}/models"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/models/trend_dow").count() == obs.count()
    assert sk.read_predictions(spark, f"{tmp_dir}/pred").count() == obs.count()
    assert main(["analyze", "--predictions", f"{tmp_dir}/pred", "--kind", "summary_statistics",
                 "--out", f"{tmp_dir}/out"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/out/by_location").count() == obs.select("location").distinct().count()


def test_failed_fit_is_isolated(spark):
    """A cutoff with no training data fails its fit; its origins get nulls, others are scored."""
    from trendlake.operators.regress import rolling_regression
    obs = jobs.prepped(observations(spark, "/root/testdata/sf0.01"))
    out = rolling_regression(obs, model="rf", num_trees=2, max_depth=2, refit=["1980-01-01", "1998-01-01"])
    got = {r.model_cutoff: (r.total, r.scored) for r in
           out.groupBy("model_cutoff").agg(F.count("*").alias("total"),
                                           F.count("new_deaths_predicted").alias("scored")).collect()}
    import datetime as dt
    assert got[dt.date(1980, 1, 1)][1] == 0 and got[dt.date(1980, 1, 1)][0] > 0
    assert got[dt.date(1998, 1, 1)][1] > 0


def test_empty_prediction_table_analyses(spark, tmp_dir):
    """Every analysis of an empty (missing) prediction table runs and returns no data."""
    empty = sk.read_predictions(spark, f"{tmp_dir}/missing")
    for kind in ("predictions", "data_analysis", "error_analysis", "summary_statistics"):
        for name, df in an.analyze(empty, kind).items():
            rows = df.collect()
            if name in ("describe", "describe_dates"):  # one row per column, count 0
                assert rows and all(r["count"] == 0 for r in rows)
            elif name == "correlation":  # like pandas: the full matrix, all missing
                assert len(rows) == 49 and all(r.corr is None for r in rows)
            else:
                assert rows == [], (kind, name)


def test_summary_statistics_approx(spark):
    pred = jobs.forecast_predictions(observations(spark, SF))
    exact = {r.metric: r for r in an.analyze(pred, "summary_statistics")["describe"].collect()}
    approx = {r.metric: r for r in an.analyze(pred, "summary_statistics", approx=True)["describe"].collect()}
    assert exact.keys() == approx.keys()
    for m, r in exact.items():
        assert r["count"] == approx[m]["count"] and r.mean == pytest.approx(approx[m].mean)
        if r.q50 is not None:
            assert r.min <= approx[m].q50 <= r.max


def _short_series(spark, days=12, replay=False):
    import datetime as dt
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=k), float(k * k % 11), float(k * 2 % 7)) for k in range(days)]
    if replay:
        rows.append(rows[5])
    df = spark.createDataFrame(rows, "location string, date date, new_cases double, new_deaths double")
    zero = {c: F.lit(1.0) for c in ("total_cases", "total_deaths", "life_expectancy", "excess_mortality", "new_vaccinations",
                                    "total_vaccinations", "people_vaccinated", "people_fully_vaccinated")}
    return df.withColumns(zero)


def test_daily_refits_score_every_origin_from_the_second_day(spark):
    from trendlake.operators.regress import rolling_regression
    got = rolling_regression(_short_series(spark), "rf", refit="day", num_trees=2, max_depth=2).orderBy("date").collect()
    assert [r.new_deaths_predicted is not None for r in got] == [False] + [True] * 11
    assert all(r.model_cutoff == r.date for r in got[1:])


def test_failed_fits_give_their_reason(spark):
    from trendlake.operators.regress import rolling_regression
    import datetime as dt
    got = rolling_regression(_short_series(spark), "rf", refit=[dt.date(2020, 1, 1), dt.date(2020, 1, 5)],
                             num_trees=2, max_depth=2).orderBy("date").collect()
    assert all(r.fit_error and r.new_deaths_predicted is None for r in got if r.date < dt.date(2020, 1, 5))
    assert all(r.fit_error is None and r.new_deaths_predicted is not None for r in got if r.date >= dt.date(2020, 1, 5))


def test_combined_rows_are_not_multiplied_by_replayed_days_and_follow_seasonality(spark):
    obs = _short_series(spark, days=60, replay=True)
    kw = {"num_trees": 2, "max_depth": 2}
    weekly = jobs.backtest(obs, models=("rf",), combine=True, regress_kwargs=kw)
    assert weekly.count() == 61
    yearly = jobs.backtest(obs, models=("rf",), combine=True, regress_kwargs=kw, seasonality=("weekly", "yearly"))
    a = {r.date: r.new_cases_predicted for r in weekly.collect()}
    b = {r.date: r.new_cases_predicted for r in yearly.collect()}
    assert any(abs(a[d] - b[d]) > 1e-9 for d in a)


def test_predictions_of_other_locations_survive_a_run_of_one(spark, tmp_dir):
    from trendlake.sinks.tables import read_predictions, write_predictions
    p = jobs.forecast_predictions(_short_series(spark))
    write_predictions(p, f"{tmp_dir}/p")
    write_predictions(p.withColumn("location", F.lit("B")), f"{tmp_dir}/p")
    write_predictions(p.withColumn("location", F.lit("B")), f"{tmp_dir}/p")
    assert read_predictions(spark, f"{tmp_dir}/p", dedup=False).groupBy("location").count().orderBy("location").collect() == [
        ("A", 12), ("B", 12)]


def test_interactive_analysis_from_the_command_line(spark, tmp_dir):
    import pytest
    from trendlake.__main__ import main
    from trendlake.sinks.tables import write_predictions
    write_predictions(jobs.forecast_predictions(_short_series(spark, days=40)), f"{tmp_dir}/p")
    base = ["--master", "local[4]", "analyze", "--predictions", f"{tmp_dir}/p", "--kind", "interactive", "--out", f"{tmp_dir}/o"]
    main([*base, "--chart", "histogram", "--x", "new_cases_actual"])
    parts = {r.part: r["count"] for r in spark.read.parquet(f"{tmp_dir}/o/chart").groupBy("part").count().collect()}
    assert parts["curve"] == 200 and parts["bar"] > 1
    with pytest.raises(SystemExit):
        main(base)


def test_pairs_of_a_fit_are_laid_out_by_their_number(spark):
    """A fit's tasks follow the pairs, not the shuffle partitions of the tables behind them."""
    from trendlake.operators import regress
    obs = spark.sql("""select l as location, date_add(date '2020-01-01', cast(i as int)) as date, cast(i % 7 as double) as new_cases,
                              cast(i % 5 as double) as new_deaths, 0.0D as new_vaccinations, cast(i as double) as total_cases,
                              cast(i as double) as total_deaths, 70.0D as life_expectancy, 0.0D as excess_mortality
                       from range(1000) t(i), (select explode(array('A', 'B', 'C', 'D')) as l) union all
                       select null, null, 1, 1, 0, 1, 1, 70, 0""")
    pairs = regress.training_pairs(obs)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        many = regress.stored_pairs(pairs)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        few = regress.stored_pairs(pairs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert len(many.inputFiles()) <= 3 and len(few.inputFiles()) <= 2  # 4,001 pairs
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty() and many.count() == 4001
