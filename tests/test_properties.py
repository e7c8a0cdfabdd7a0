"""Property-based checks (hypothesis) against brute force on small random inputs."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_fixtures import _brute_forecast
from trendlake.operators import forecast as fc
from trendlake.operators.quantiles import quantiles

D0 = dt.date(2021, 3, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

series = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 60), st.integers(0, 9)),
    min_size=1, max_size=60)


@SETTINGS
@given(series)
def test_forecast_equals_per_origin_refit(spark, rows):
    uniq = {}
    for loc, d, y in rows:
        uniq[(loc, d)] = float(y)  # one row per (location, day)
    data = [(loc, D0 + dt.timedelta(days=d), y) for (loc, d), y in uniq.items()]
    df = spark.createDataFrame(data, "location string, date date, new_cases double")
    got = {(r.location, r.date): r.new_cases_predicted for r in fc.forecast(df).collect()}
    for loc in {r[0] for r in data}:
        pts = sorted((d, y) for l2, d, y in data if l2 == loc)
        want = _brute_forecast([p[0] for p in pts], [p[1] for p in pts])
        for d, w in want.items():
            if w is None:
                assert got[(loc, d)] is None
            else:
                assert got[(loc, d)] == pytest.approx(w, abs=1e-6)


groups = st.lists(st.tuples(st.sampled_from(["x", "y", None]),
                            st.floats(-1e3, 1e3, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=80)


@SETTINGS
@given(groups, st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_quantiles_equal_numpy(spark, rows, probs):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in quantiles(df, "v", ["g"], probs=tuple(probs), limit=7).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for k, v in rows if k == g])
        assert got[g].n == len(vals)
        assert np.allclose(got[g].quantiles, np.percentile(vals, [100 * p for p in probs]), rtol=1e-9, atol=1e-9)


values = st.lists(st.floats(-50, 50, allow_nan=False, allow_infinity=False).map(lambda v: round(v, 2)),
                  min_size=1, max_size=120)


@SETTINGS
@given(values)
def test_histogram_auto_equals_numpy(spark, vals):
    from trendlake.operators.explore import histogram
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = sorted((r.bin, r["count"]) for r in histogram(df, "v").collect())
    counts, edges = np.histogram(np.array(vals), bins="auto")
    assert [c for _, c in got] == counts.tolist()
    assert len(got) == len(edges) - 1


@SETTINGS
@given(values)
def test_box_stats_equal_numpy(spark, vals):
    from trendlake.operators.explore import box_stats
    x = np.array(vals)
    r = box_stats(spark.createDataFrame([(float(v),) for v in vals], "v double"), "v").first()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
    assert r.whisker_lo == x[x >= lo].min() and r.whisker_hi == x[x <= hi].max()
    assert r.n_outliers == int(((x < lo) | (x > hi)).sum())


cells = st.one_of(st.none(), st.floats(-20, 20, allow_nan=False, allow_infinity=False).map(lambda v: round(v, 1)))
frames = st.lists(st.tuples(cells, cells, cells), min_size=1, max_size=40)


@SETTINGS
@given(frames)
def test_describe_equals_pandas(spark, rows):
    import pandas as pd

    from trendlake.operators.explore import describe
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r.metric: r for r in describe(df, ["a", "b", "c"]).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"], dtype=float).describe()
    for col in "abc":
        w, g = want[col], got[col]
        assert g["count"] == int(w["count"])
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            if np.isnan(w[theirs]):
                assert g[mine] is None, (col, mine)
            else:
                assert g[mine] == pytest.approx(w[theirs], rel=1e-9, abs=1e-9), (col, mine)


@SETTINGS
@given(frames)
def test_corr_equals_pandas(spark, rows):
    import pandas as pd

    from trendlake.operators.explore import corr_matrix
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.row_metric, r.col_metric): r.corr for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"], dtype=float).corr()
    for x in "abc":
        for y in "abc":
            w = want.loc[x, y]
            if np.isnan(w):
                assert got[(x, y)] is None, (x, y)
            else:
                assert got[(x, y)] == pytest.approx(w, abs=1e-9), (x, y)


pairs = st.lists(st.tuples(st.integers(0, 9).map(float), st.integers(0, 9).map(float)), min_size=1, max_size=40)


@SETTINGS
@given(pairs)
def test_metrics_equal_numpy(spark, rows):
    from trendlake.operators.evaluate import metrics
    r = metrics(spark.createDataFrame(rows, "a double, p double"), "a", "p").first()
    a = np.array([x for x, _ in rows]); p = np.array([y for _, y in rows])
    assert r.n == len(a)
    assert r.rmse == pytest.approx(np.sqrt(np.mean((a - p) ** 2)))
    assert r.mae == pytest.approx(np.mean(np.abs(a - p)))
    sst = ((a - a.mean()) ** 2).sum()
    if sst == 0:
        assert r.r2 is None
    else:
        assert r.r2 == pytest.approx(1 - ((a - p) ** 2).sum() / sst, abs=1e-9)


stat_rows = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 30), cells, cells),
                     min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(stat_rows)
def test_location_stats_equal_pandas(spark, rows):
    import pandas as pd

    from trendlake.operators.explore import location_stats
    data = sorted(((loc, D0 + dt.timedelta(days=d), x, y) for loc, d, x, y in rows), key=lambda r: r[1])
    df = spark.createDataFrame(data, "location string, date date, new_cases_actual double, total_cases double")
    df = df.withColumns({c: F.col("new_cases_actual")
                         for c in ("new_deaths_actual", "total_deaths", "life_expectancy", "excess_mortality")})
    got = {r.location: r for r in location_stats(df).collect()}
    pdf = pd.DataFrame(data, columns=["location", "date", "new_cases_actual", "total_cases"]).astype(
        {"new_cases_actual": float, "total_cases": float})
    want = pdf.groupby("location").agg({"new_cases_actual": ["mean", "std", "max"], "total_cases": "last"})
    for loc in want.index:
        g = got[loc]
        for mine, (col, fn) in (("new_cases_actual_mean", ("new_cases_actual", "mean")),
                                ("new_cases_actual_std", ("new_cases_actual", "std")),
                                ("new_cases_actual_max", ("new_cases_actual", "max")),
                                ("total_cases_last", ("total_cases", "last"))):
            w = want.loc[loc, (col, fn)]
            if pd.isna(w):
                assert g[mine] is None, (loc, mine)
            else:
                assert g[mine] == pytest.approx(w, abs=1e-9), (loc, mine)
