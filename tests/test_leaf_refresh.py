"""Daily leaf values against brute force on the same trees."""

import datetime as dt
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trendlake.operators import leaf_refresh as lr
from trendlake.operators import regress as rg

START = dt.date(2020, 1, 1)


def observations(spark, days=60, locations=("A", "B", "C"), seed=1):
    r = random.Random(seed)
    rows, gone = [], 0
    for loc in locations:
        total = 0.0
        for i in range(days):
            if r.random() < 0.15:
                gone += 1
                continue
            cases = float(r.randint(0, 9))
            total += cases
            rows.append((loc, START + dt.timedelta(i), cases, 0.5 * cases + (i > 30) + r.random(), 0.0, total, total / 50, 70.0, r.random()))
    assert gone
    return spark.createDataFrame(rows, "location string, date date, new_cases double, new_deaths double, new_vaccinations double, "
                                       "total_cases double, total_deaths double, life_expectancy double, excess_mortality double")


@pytest.mark.parametrize("mode", ["lagged", "next_day"])
def test_predictions_are_leaf_means_of_the_day(spark, monkeypatch, mode):
    models = {}
    plain = lr.make_estimator

    class Kept:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, train):
            model = self.estimator.fit(train)
            models[train.agg(F.max("label_date")).first()[0]] = model
            return model

    monkeypatch.setattr(lr, "make_estimator", lambda *a, **k: Kept(plain(*a, **k)))
    obs = observations(spark)
    cutoffs = [START + dt.timedelta(20), START + dt.timedelta(40)]
    got = {(r["location"], r["date"]): r for r in lr.daily_forest(obs, refit=cutoffs, mode=mode, num_trees=4, max_depth=3, parallelism=1).collect()}
    assert len(got) == obs.count()
    pairs = rg.training_pairs(obs, mode=mode)
    fitted = [models[k] for k in sorted(models)]
    assert len(fitted) == 2
    for model, cutoff, until in zip(fitted, cutoffs, [cutoffs[1], dt.date(2100, 1, 1)]):
        def rows(column):
            out = model.setFeaturesCol(column).setLeafCol("leaf").transform(pairs)
            return out.select("location", "date", "label", "label_date", "scorable", vector_to_array("leaf").alias("leaf")).collect()
        known = [r for r in rows("features") if r["label"] is not None]
        for o in rows("score_features"):
            if not cutoff <= o["date"] < until:
                continue
            means = []
            for tree, leaf in enumerate(o["leaf"]):
                labels = [r["label"] for r in known if r["label_date"] <= o["date"] and r["leaf"][tree] == leaf]
                means.append(sum(labels) / len(labels))
            have = got[o["location"], o["date"]]
            assert have["model_cutoff"] == cutoff
            if o["scorable"]:
                assert have["new_deaths_predicted"] == pytest.approx(sum(means) / len(means), abs=1e-9)
            else:
                assert have["new_deaths_predicted"] is None
    assert all(r["new_deaths_predicted"] is None and r["model_cutoff"] is None for (_, d), r in got.items() if d < cutoffs[0])


def test_labels_after_an_origin_change_nothing(spark):
    obs = observations(spark)
    cutoffs = [START + dt.timedelta(20)]
    options = {"refit": cutoffs, "num_trees": 3, "max_depth": 3}
    day = START + dt.timedelta(45)
    whole = {(r["location"], r["date"]): r["new_deaths_predicted"] for r in lr.daily_forest(obs, **options).collect()}
    changed = obs.withColumn("new_deaths", F.when(F.col("date") > F.lit(day), F.lit(1e6)).otherwise(F.col("new_deaths")))
    for r in lr.daily_forest(changed, **options).collect():
        if r["date"] <= day and whole[r["location"], r["date"]] is not None:
            assert r["new_deaths_predicted"] == pytest.approx(whole[r["location"], r["date"]], abs=1e-9)


def test_failed_fit_is_reported(spark, monkeypatch):
    class Broken:
        def fit(self, train):
            raise RuntimeError("no luck")

    monkeypatch.setattr(lr, "make_estimator", lambda *a, **k: Broken())
    got = lr.daily_forest(observations(spark, 30), refit=[START + dt.timedelta(10)]).collect()
    assert {r["fit_error"] for r in got if r["date"] >= START + dt.timedelta(10)} == {"RuntimeError: no luck"}
    assert all(r["new_deaths_predicted"] is None for r in got)
    zero = lr.daily_forest(observations(spark, 30).limit(0), refit="year").collect()
    assert zero == []
