"""Micro fixtures with hand-computed expectations (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendlake.functions.exprs import null_safe_corr
from trendlake.operators import evaluate as ev
from trendlake.operators import explore as ex
from trendlake.operators import forecast as fc
from trendlake.operators.prep import fill_nulls, next_day
from trendlake.streaming.ingest import parse

D0 = dt.date(2020, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_ok(spark):
    r = parse(msgs(spark, ['{"location":"A","date":"2020-01-01","total_cases":5,"new_cases":1.5,"x":9}'])).first()
    assert (r.location, r.date, r.total_cases, r.new_cases) == ("A", D0, 5.0, 1.5)
    assert r._corrupt_record is None


def test_parse_not_json(spark):
    r = parse(msgs(spark, ["not json"])).first()
    assert r.location is None and r.date is None and r.total_cases is None
    assert r._corrupt_record == "not json"


def test_parse_bad_type(spark):
    raw = '{"location":"B","date":"bad","total_cases":"oops","new_cases":2}'
    r = parse(msgs(spark, [raw])).first()
    assert (r.location, r.date, r.total_cases, r.new_cases) == ("B", None, None, 2.0)
    assert r._corrupt_record == raw


def test_parse_null(spark):
    r = parse(msgs(spark, [None])).first()
    assert all(v is None for v in r)


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None)], "s string, x double")
    r = fill_nulls(df).first()
    assert r.s is None and r.x == 0.0


def _metrics(spark, actual, predicted):
    df = spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], "a double, p double")
    return ev.metrics(df, "a", "p").first()


def test_metrics_basic(spark):
    r = _metrics(spark, [1, 2, 3, 4], [1, 2, 3, 6])
    assert r.rmse == pytest.approx(1.0) and r.mae == pytest.approx(0.5) and r.r2 == pytest.approx(0.2)


def test_metrics_constant(spark):
    r = _metrics(spark, [5, 5], [4, 6])
    assert r.rmse == pytest.approx(1.0) and r.mae == pytest.approx(1.0) and r.r2 is None


def test_metrics_empty(spark):
    df = spark.createDataFrame([("m", 1.0, 1.0)], "model_version string, a double, p double")
    out = ev.metrics(df.filter(F.col("model_version") == "other"), "a", "p", by=["model_version"])
    assert out.count() == 0


def test_corr_basic(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0), (None, 1.0), (3.0, 1.0)], "x double, y double")
    assert df.agg(null_safe_corr("x", "y")).first()[0] == pytest.approx(-0.240192, abs=1e-6)


def test_corr_constant(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    assert df.agg(null_safe_corr("x", "y")).first()[0] is None


def test_std_single_and_quartiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    r = ex.describe(df, ["v"]).first()
    assert (r.q25, r.q50, r.q75) == (1.75, 2.5, 3.25)
    one = ex.describe(df.limit(1), ["v"]).first()
    assert one.std is None


def test_last_by_date(spark):
    df = spark.createDataFrame([("L", day(0), 7.0), ("L", day(1), 9.0), ("L", day(2), None)],
                               "location string, date date, total_cases double")
    for c in ("new_cases_actual", "new_deaths_actual", "total_deaths", "life_expectancy", "excess_mortality"):
        df = df.withColumn(c, F.lit(1.0))
    assert ex.location_stats(df).first().total_cases_last == 9.0


def test_next_day_gap(spark):
    df = spark.createDataFrame([("L", day(1), 1.0), ("L", day(2), 2.0), ("L", day(4), 4.0)],
                               "location string, date date, v double")
    got = {r.date: r.next_v for r in next_day(df, ["v"]).collect()}
    assert got == {day(1): 2.0, day(2): None, day(4): None}


def test_forecast_short(spark):
    df = spark.createDataFrame([("L", day(0), 3.0)], "location string, date date, new_cases double")
    assert fc.forecast(df).first().new_cases_predicted is None


def test_forecast_line(spark):
    rows = [("L", day(t), 3.0 + 2 * t) for t in range(21)]
    df = spark.createDataFrame(rows, "location string, date date, new_cases double")
    last = fc.forecast(df).filter(F.col("date") == day(20)).first()
    assert last.target_date == day(21)
    assert last.new_cases_predicted == pytest.approx(45.0, abs=1e-9)


def _brute_forecast(days, ys):
    """Refit per origin: least-squares line on t plus mean weekday residual (numpy)."""
    import numpy as np
    t0 = days[0]
    out = {}
    for i, d in enumerate(days):
        t = np.array([(x - t0).days for x in days[:i + 1]], float)
        y = np.array(ys[:i + 1], float)
        if len(t) < 2 or np.all(t == t[0]):
            out[d] = None
            continue
        b = ((t - t.mean()) * (y - y.mean())).sum() / ((t - t.mean()) ** 2).sum()
        a = y.mean() - b * t.mean()
        nxt = (d + dt.timedelta(days=1)).weekday()
        same = [k for k, x in enumerate(days[:i + 1]) if x.weekday() == nxt]
        seas = float(np.mean([y[k] - a - b * t[k] for k in same])) if same else 0.0
        out[d] = a + b * ((d - t0).days + 1) + seas
    return out


def test_forecast_matches_brute_force(spark):
    import random
    rnd = random.Random(3)
    days = sorted({day(rnd.randrange(0, 120)) for _ in range(70)})
    ys = [float(rnd.randrange(0, 9)) for _ in days]
    df = spark.createDataFrame([("L", d, y) for d, y in zip(days, ys)], "location string, date date, new_cases double")
    got = {r.date: r.new_cases_predicted for r in fc.forecast(df).collect()}
    want = _brute_forecast(days, ys)
    for d in days:
        if want[d] is None:
            assert got[d] is None
        else:
            assert got[d] == pytest.approx(want[d], abs=1e-7)


def test_no_look_ahead(spark):
    from trendlake.sources.tables import observations
    obs = observations(spark, "/root/testdata/sf0.001")
    cut = dt.date(1997, 1, 1)
    a = fc.forecast(obs).filter(F.col("date") <= cut)
    b = fc.forecast(obs.filter(F.col("date") <= cut))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_forecast_order_invariant(spark):
    from trendlake.sources.tables import observations
    obs = observations(spark, "/root/testdata/sf0.001")
    a = fc.forecast(obs)
    b = fc.forecast(obs.orderBy(F.rand(7)).repartition(3))
    assert a.exceptAll(b).count() == 0


def test_unknown_model(spark):
    from trendlake.operators.regress import make_estimator
    with pytest.raises(ValueError):
        make_estimator("svm")


def test_missing_target_column(spark):
    from trendlake.operators.regress import training_pairs
    df = spark.createDataFrame([("L", day(0), 1.0)], "location string, date date, new_cases double")
    with pytest.raises(ValueError):
        training_pairs(df)


def test_model_state_reproduces_forecast(spark):
    rows = [("L", day(t), float((t * 7) % 5)) for t in range(30)]
    df = spark.createDataFrame(rows, "location string, date date, new_cases double")
    st = {r.date: r for r in fc.model_state(df).collect()}
    pred = {r.date: r.new_cases_predicted for r in fc.forecast(df).collect()}
    for d, r in st.items():
        if pred[d] is None:
            continue
        k = (d + dt.timedelta(days=1)).isoweekday() % 7  # Sunday first
        eff = r.weekday_effect_new_cases[k] or 0.0
        assert r.intercept_new_cases + r.slope_new_cases * (r.t + 1) + eff == pytest.approx(pred[d], abs=1e-9)


def test_pooled_forecast_matches_row_regression(spark):
    """Q7 pooled mode: one line fitted over all rows of all locations up to each day."""
    import numpy as np
    rows = [("A", day(t), float((3 * t) % 7)) for t in range(0, 40, 1)] + \
           [("B", day(t), float((5 * t) % 4)) for t in range(5, 40, 3)]
    df = spark.createDataFrame(rows, "location string, date date, new_cases double")
    got = {(r.location, r.date): r.new_cases_predicted for r in fc.forecast(df, partition=[]).collect()}
    t0 = min(r[1] for r in rows)
    for loc, d, _ in rows:
        frame = [(float((x[1] - t0).days), x[2], x[1]) for x in rows if x[1] <= d]
        t = np.array([f[0] for f in frame]); y = np.array([f[1] for f in frame])
        if len(t) < 2 or np.all(t == t[0]):
            assert got[(loc, d)] is None
            continue
        b = ((t - t.mean()) * (y - y.mean())).sum() / ((t - t.mean()) ** 2).sum()
        a = y.mean() - b * t.mean()
        nxt = (d + dt.timedelta(days=1)).weekday()
        res = [y[j] - a - b * t[j] for j, f in enumerate(frame) if f[2].weekday() == nxt]
        want = a + b * ((d - t0).days + 1) + (float(np.mean(res)) if res else 0.0)
        assert got[(loc, d)] == pytest.approx(want, abs=1e-6)


def test_yearly_seasonality_matches_brute_force(spark):
    import random

    import numpy as np
    rnd = random.Random(9)
    days = sorted({day(rnd.randrange(0, 800)) for _ in range(300)})
    ys = [float(rnd.randrange(0, 9)) + (3.0 if d.month in (6, 7) else 0.0) for d in days]
    df = spark.createDataFrame([("L", d, y) for d, y in zip(days, ys)], "location string, date date, new_cases double")
    got = {r.date: r.new_cases_predicted for r in fc.forecast(df, seasonality=("weekly", "yearly")).collect()}
    pooled = {r.date: r.new_cases_predicted
              for r in fc.forecast(df, partition=[], seasonality=("weekly", "yearly")).collect()}
    t0 = days[0]
    for i, d in enumerate(days):
        t = np.array([(x - t0).days for x in days[:i + 1]], float)
        y = np.array(ys[:i + 1])
        if len(t) < 2:
            assert got[d] is None and pooled[d] is None
            continue
        b = ((t - t.mean()) * (y - y.mean())).sum() / ((t - t.mean()) ** 2).sum()
        a = y.mean() - b * t.mean()
        res = y - a - b * t
        nxt = d + dt.timedelta(days=1)
        wk = [res[j] for j, x in enumerate(days[:i + 1]) if x.weekday() == nxt.weekday()]
        mo = [res[j] for j, x in enumerate(days[:i + 1]) if x.month == nxt.month]
        want = a + b * ((d - t0).days + 1) + (np.mean(wk) if wk else 0.0) + (np.mean(mo) if mo else 0.0)
        assert got[d] == pytest.approx(want, abs=1e-6)
        assert pooled[d] == pytest.approx(want, abs=1e-6)
    state = fc.model_state(df, seasonality=("weekly", "yearly")).first()
    assert len(state.month_effect_new_cases) == 12 and len(state.weekday_effect_new_cases) == 7
    with pytest.raises(ValueError):
        fc.forecast(df, seasonality=("hourly",))


def test_trailing_window_matches_brute_force(spark):
    import random

    import numpy as np
    rnd = random.Random(4)
    days = sorted({day(rnd.randrange(0, 90)) for _ in range(60)})
    ys = [float(rnd.randrange(0, 9)) + 0.1 * (d - D0).days for d in days]
    df = spark.createDataFrame([("L", d, y) for d, y in zip(days, ys)], "location string, date date, new_cases double")
    k = 14
    got = {r.date: r.new_cases_predicted for r in fc.forecast(df, history_days=k).collect()}
    pooled = {r.date: r.new_cases_predicted for r in fc.forecast(df, partition=[], history_days=k).collect()}
    t0 = days[0]
    for d in days:
        idx = [j for j, x in enumerate(days) if d - dt.timedelta(days=k - 1) <= x <= d]
        t = np.array([(days[j] - t0).days for j in idx], float)
        y = np.array([ys[j] for j in idx])
        if len(t) < 2 or np.all(t == t[0]):
            assert got[d] is None and pooled[d] is None
            continue
        b = ((t - t.mean()) * (y - y.mean())).sum() / ((t - t.mean()) ** 2).sum()
        a = y.mean() - b * t.mean()
        nxt = (d + dt.timedelta(days=1)).weekday()
        res = [y[m] - a - b * t[m] for m, j in enumerate(idx) if days[j].weekday() == nxt]
        want = a + b * ((d - t0).days + 1) + (float(np.mean(res)) if res else 0.0)
        assert got[d] == pytest.approx(want, abs=1e-6)
        assert pooled[d] == pytest.approx(want, abs=1e-6)


def test_parse_binary_kafka_value(spark):
    """A Kafka-style binary value is cast to string before parsing."""
    raw = '{"location":"A","date":"2020-01-02","new_deaths":3}'
    df = spark.createDataFrame([(bytearray(raw.encode("utf-8")),)], "value binary")
    r = parse(df).first()
    assert (r.location, r.date, r.new_deaths) == ("A", day(1), 3.0)


def test_location_filter_all(spark):
    """One location, a list, or 'all' in any case (no filter)."""
    from trendlake.operators.prep import filter_locations
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "location string")
    assert filter_locations(df, "B").count() == 1
    assert filter_locations(df, ["A", "C"]).count() == 2
    assert filter_locations(df, "ALL").count() == 3 and filter_locations(df, None).count() == 3
