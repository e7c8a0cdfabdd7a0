"""The Fourier forecast against a numpy refit at every origin."""

import datetime as dt
import random

import numpy as np
import pytest

from trendlake.operators import fourier as fo


def plain(rows, hinges=8, hinge_days=240, weekly=3, yearly=3, share=0.8, hinge_ridge=20.0, season_ridge=1.0):
    """(date, y) in order -> forecast of the next day at each, by a fit of its own."""
    first = rows[0][0]
    ridge = np.array(fo.ridges(hinges, weekly, yearly, hinge_ridge, season_ridge))

    def x(day):
        t, n = (day - first).days, (day - dt.date(1970, 1, 1)).days
        v = [1, t / fo.YEAR] + [max(0, t - j * hinge_days) / fo.YEAR for j in range(1, hinges + 1)]
        for period, order in ((7, weekly), (fo.YEAR, yearly)):
            for k in range(1, order + 1):
                v += [np.sin(2 * np.pi * k * n / period), np.cos(2 * np.pi * k * n / period)]
        return np.array(v)

    out = []
    for d, _ in rows:
        t = (d - first).days
        on = [True, True] + [share * t >= j * hinge_days for j in range(1, hinges + 1)]
        on = np.array(on + [t >= 14] * 2 * weekly + [t >= 730] * 2 * yearly)
        a = np.array([x(e)[on] for e, _ in rows if e <= d])
        y = np.array([0 if v is None else v for e, v in rows if e <= d])
        if t == 0:
            out.append(None)
            continue
        beta = np.linalg.solve(a.T @ a + np.diag(ridge[on]), a.T @ y)
        out.append(float(x(d + dt.timedelta(1))[on] @ beta))
    return out


def series(seed, days, gap=0.2):
    r = random.Random(seed)
    start = dt.date(2019, 5, 3)
    return [(start + dt.timedelta(i), None if r.random() < 0.05 else 5 + 0.02 * i * (1 if i < 300 else -1) + 2 * np.sin(i / 58) + (i % 7) / 2 + r.random())
            for i in range(days) if i == 0 or r.random() > gap]


@pytest.mark.parametrize("options", [{}, {"hinges": 2, "hinge_days": 50, "weekly": 1, "yearly": 1, "hinge_ridge": 0.5}])
def test_every_origin_equals_its_own_fit(spark, options):
    data = {"A": series(1, 900), "B": series(2, 40), "C": series(3, 1), "D": [(dt.date(2020, 1, 1), 3.0), (dt.date(2020, 1, 2), 5.0)]}
    rows = [(loc, d, None if y is None else float(y)) for loc, s in data.items() for d, y in s]
    random.Random(0).shuffle(rows)
    obs = spark.createDataFrame(rows, "location string, date date, new_cases double")
    got = {(r["location"], r["date"]): r["new_cases_predicted"] for r in fo.forecast_fourier(obs, **options).collect()}
    assert len(got) == len(rows)
    for loc, s in data.items():
        for (d, _), want in zip(s, plain(s, **options)):
            have = got[loc, d]
            assert (have is None) == (want is None)
            if want is not None:
                assert have == pytest.approx(want, abs=1e-6, rel=1e-7), (loc, d)


def test_learns_a_trend_change_and_a_season(spark):
    start = dt.date(2015, 1, 1)
    y = [(start + dt.timedelta(i), 0.05 * min(i, 500) + 3 * float(np.sin(2 * np.pi * i / fo.YEAR)) + (i % 7 == 0)) for i in range(1500)]
    obs = spark.createDataFrame([("X", d, v) for d, v in y], "location string, date date, new_cases double")
    got = {r["date"]: r["new_cases_predicted"] for r in fo.forecast_fourier(obs).collect()}
    late = [(got[d], y[i + 1][1]) for i, (d, _) in enumerate(y[:-1]) if i > 1200]
    assert np.sqrt(np.mean([(a - b) ** 2 for a, b in late])) < 0.6


def test_no_look_ahead_and_edge_cases(spark):
    s = series(4, 120)
    obs = spark.createDataFrame([("A", d, None if y is None else float(y)) for d, y in s], "location string, date date, new_cases double")
    whole = {r["date"]: r["new_cases_predicted"] for r in fo.forecast_fourier(obs).collect()}
    cut = fo.forecast_fourier(obs.filter("date <= date'2019-07-01'")).collect()
    assert cut and all(r["new_cases_predicted"] is None or abs(r["new_cases_predicted"] - whole[r["date"]]) < 1e-9 for r in cut)
    assert fo.forecast_fourier(obs.limit(0)).collect() == []
    assert fo.forecast_fourier(obs.limit(1), missing="zero").first()["new_cases_predicted"] == 0.0
    with pytest.raises(ValueError):
        fo.forecast_fourier(obs, "absent")
    two = fo.forecast_fourier_frame(obs.withColumn("new_deaths", obs["new_cases"] * 2), ["new_cases", "new_deaths"]).collect()
    assert all(r["yhat_new_cases"] is None or abs(2 * r["yhat_new_cases"] - r["yhat_new_deaths"]) < 1e-9 for r in two)
