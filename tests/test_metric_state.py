"""Metrics from merged states against the metrics of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trendlake.operators import evaluate as ev
from trendlake.operators import metric_state as ms


def predictions(spark, n=400, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = r.choice([None, float("nan"), 1e6 + r.random(), r.gauss(5, 2)]) if i % 9 == 0 else r.gauss(5, 2)
        rows.append((r.choice(["A", "B", None]), dt.date(2020, 1, 1) + dt.timedelta(i % 100), r.choice(["m1", "m2"]), a,
                     None if i % 13 == 0 else r.gauss(5, 2), 4.0, r.random()))
    return spark.createDataFrame(rows, "location string, date date, model_version string, new_cases_actual double, new_cases_predicted double, "
                                       "new_deaths_actual double, new_deaths_predicted double")


def test_any_split_into_increments_gives_the_metrics_of_all_rows(spark, tmp_dir):
    p = predictions(spark)
    want = {}
    for scope, by in ms.SCOPES.items():
        d = ev.stack_targets(p.withColumn("month", F.trunc("date", "month")), keep=["location", "model_version", "month"])
        for r in ev.metrics(d, "actual", "predicted", by).collect():
            row = r.asDict()
            want[scope, row.get("location"), row["model_version"], row["target"], row.get("month")] = row
    for k in range(3):
        ms.write_increment(p.filter(F.pmod(F.xxhash64("*"), F.lit(3)) == k), f"{tmp_dir}/state", str(k))
    ms.write_increment(p.filter(F.pmod(F.xxhash64("*"), F.lit(3)) == 1), f"{tmp_dir}/state", "1")  # a rerun
    ms.write_increment(p.limit(0), f"{tmp_dir}/state", "nothing")
    got = ms.scoped_metrics(ms.read_state(spark, f"{tmp_dir}/state")).collect()
    assert len(got) == len(want)
    for r in got:
        row = want[r["scope"], r["location"], r["model_version"], r["target"], r["month"]]
        assert r["n"] == row["n"]
        for name in ("rmse", "mae", "r2"):
            if row[name] is None:
                assert r[name] is None
            else:
                assert r[name] == pytest.approx(row[name], rel=1e-6, abs=1e-6)


def test_no_rows(spark):
    assert ms.scoped_metrics(ms.pair_state(predictions(spark).limit(0))).collect() == []
