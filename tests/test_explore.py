"""Exploration operators against numpy brute force on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlake.operators import explore as ex


@pytest.fixture(scope="module")
def values(spark):
    rnd = np.random.default_rng(5)
    a = np.round(rnd.normal(10, 3, 300), 2)
    b = np.round(rnd.exponential(2, 200), 2)
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("b", float("nan")), ("a", None)]
    return spark.createDataFrame(rows, "g string, v double"), {"a": a, "b": b}


def test_histogram_auto_matches_numpy(values):
    df, raw = values
    allv = np.concatenate([raw["a"], raw["b"]])
    edges = np.histogram_bin_edges(allv, bins="auto")
    got = ex.histogram(df, "v", "g").collect()
    for g in ("a", "b"):
        counts, _ = np.histogram(raw[g], bins=edges)
        mine = {r.bin: r["count"] for r in got if r.g == g}
        assert len(edges) - 1 == max(r.bin for r in got) + 1 or len(mine) <= len(edges) - 1
        assert [mine.get(i, 0) for i in range(len(edges) - 1)] == counts.tolist()


def test_kde_matches_direct_sum(values):
    df, raw = values
    got = sorted(ex.kde(df, "v", "g", cut=3.0).filter("g = 'a'").collect(), key=lambda r: r.grid)
    x = raw["a"]
    h = x.std(ddof=1) * len(x) ** (-0.2)
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert len(got) == 200
    assert np.allclose([r.density for r in got], dens, atol=1e-12)
    assert np.allclose([r.x for r in got], grid, atol=1e-9)


def test_box_matches_numpy(values):
    df, raw = values
    r = ex.box_stats(df, "v", ["g"]).filter("g = 'b'").first()
    x = raw["b"]
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
    assert r.whisker_lo == x[x >= lo].min() and r.whisker_hi == x[x <= hi].max()
    assert r.n_outliers == int(((x < lo) | (x > hi)).sum())


def test_describe_matches_numpy(values):
    df, raw = values
    r = ex.describe(df, ["v"]).first()
    x = np.concatenate([raw["a"], raw["b"]])
    assert r["count"] == len(x)
    assert r.mean == pytest.approx(x.mean()) and r.std == pytest.approx(x.std(ddof=1))
    assert (r.q25, r.q50, r.q75) == pytest.approx(tuple(np.percentile(x, [25, 50, 75])))


def test_corr_matrix_symmetric(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 5.0, 5.0), (3.0, 1.0, 5.0)], "x double, y double, z double")
    m = {(r.row_metric, r.col_metric): r.corr for r in ex.corr_matrix(df, ["x", "y", "z"]).collect()}
    assert len(m) == 9 and m[("x", "y")] == m[("y", "x")]
    assert m[("x", "x")] == pytest.approx(1.0) and m[("x", "z")] is None


def test_mean_ci(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, v double")
    got = {r.k: r for r in ex.mean_ci(df, "k", "v").collect()}
    assert got["a"].mean == 2.0 and got["a"].ci_lo == pytest.approx(2 - 1.96 * math.sqrt(2) / math.sqrt(2))
    assert got["b"].ci_lo is None


def test_column_types_and_label(spark):

    from trendlake.functions.exprs import label
    df = spark.createDataFrame([("a", 1.0)], "location string, new_cases_actual double").withColumn("date", F.current_date())
    t = ex.column_types(df)
    assert t == {"numeric": ["new_cases_actual"], "categorical": ["location"], "date": ["date"]}
    assert df.select(label(F.lit("new_cases_actual"))).first()[0] == "New Cases Actual"


def test_distributed_quantiles_hot_group(spark):
    """A group holding most rows is narrowed by sketches; results stay exact."""
    from trendlake.operators.quantiles import quantiles
    rnd = np.random.default_rng(11)
    hot = rnd.normal(0, 1, 3000)
    rows = [("hot", float(v)) for v in hot] + [("cold", 1.0), ("cold", 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.quantiles) for r in quantiles(df, "v", ["g"], probs=(0.1, 0.5, 0.99), limit=50).collect()}
    assert got["hot"][0] == 3000
    assert np.allclose(got["hot"][1], np.percentile(hot, [10, 50, 99]))
    assert got["cold"][1] == pytest.approx([1.1, 1.5, 1.99])
    assert got[None][1] == [4.0, 4.0, 4.0]
    approx = {r.g: r.quantiles for r in quantiles(df, "v", ["g"], method="approx").collect()}
    assert abs(approx["hot"][1] - np.median(hot)) < 0.05


def test_bootstrap_ci_close_to_normal(spark):
    rnd = np.random.default_rng(2)
    rows = [("a", float(v)) for v in rnd.normal(5, 2, 400)] + [("b", 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    norm = {r.k: r for r in ex.mean_ci(df, "k", "v").collect()}
    boot = {r.k: r for r in ex.mean_ci(df, "k", "v", ci="bootstrap", n_boot=400, seed=3).collect()}
    again = {r.k: r for r in ex.mean_ci(df, "k", "v", ci="bootstrap", n_boot=400, seed=3).collect()}
    assert boot["a"].ci_lo == again["a"].ci_lo and boot["a"].ci_hi == again["a"].ci_hi
    width_n = norm["a"].ci_hi - norm["a"].ci_lo
    width_b = boot["a"].ci_hi - boot["a"].ci_lo
    assert abs(width_b - width_n) / width_n < 0.25
    assert boot["a"].ci_lo < boot["a"].mean < boot["a"].ci_hi
    assert boot["b"].ci_lo == boot["b"].ci_hi == 3.0
    with pytest.raises(ValueError):
        ex.mean_ci(df, "k", "v", ci="nope")


def test_describe_dates_like_pandas(spark):
    import datetime as dt

    import pandas as pd
    days = ["2020-01-01", "2020-01-02", "2020-01-05", "2020-01-09"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days] + [(None,)], "date date")
    r = ex.describe_dates(df).first()
    want = pd.DataFrame({"date": pd.to_datetime(days)}).describe()["date"]
    assert (r.metric, r["count"]) == ("date", 4)
    for mine, theirs in (("mean", "mean"), ("min", "min"), ("q25", "25%"), ("q50", "50%"),
                         ("q75", "75%"), ("max", "max")):
        assert pd.Timestamp(r[mine]) == want[theirs], mine


def test_next_day_join_equals_window_form(spark):
    from trendlake.operators.prep import next_day, next_day_join
    from trendlake.sources.tables import observations
    obs = observations(spark, "/root/testdata/sf0.01").select("location", "date", "new_cases", "new_deaths")
    a = next_day(obs, ["new_cases", "new_deaths"])
    b = next_day_join(obs, ["new_cases", "new_deaths"]).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("limit", [1, 20, 100_000])
def test_selection_with_heavy_ties(spark, limit):
    """Values that hold most rows of a group, at and beside the wanted ranks, in many groups at once."""
    from trendlake.operators.quantiles import quantiles
    rnd = np.random.default_rng(5)
    data = {"ties": np.r_[np.zeros(900), rnd.normal(0, 1, 600)], "one": np.full(700, 3.5), "two": np.repeat([1.0, 2.0], 400),
            "wide": rnd.lognormal(0, 4, 2000), "edge": np.r_[np.full(1999, 7.0), 8.0], "few": np.array([2.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double").repartition(5)
    probs = (0.0, 0.3, 0.5, 0.6, 0.9995, 1.0)
    got = {r.g: r for r in quantiles(df, "v", ["g"], probs=probs, limit=limit).collect()}
    for g, vs in data.items():
        assert got[g].n == len(vs)
        assert np.allclose(got[g].quantiles, np.percentile(vs, [100 * p for p in probs]), rtol=1e-12, atol=1e-12), g
    whole = quantiles(df, "v", probs=(0.25, 0.75), limit=limit).first()
    assert np.allclose(whole.quantiles, np.percentile(np.concatenate(list(data.values())), [25, 75]))


def test_narrowing_leaves_few_rows_to_count(spark):
    """What is counted value by value at the end stays below the limit, however many rows a group has."""
    from trendlake.operators import quantiles as q
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v"))
    values = q.narrow_values(df, "v", ["g"])
    seen = []
    kept = q._inside
    q._inside = lambda *a: seen.append(kept(*a)) or seen[-1]
    try:
        got = q.quantiles_of(values, ["g"], limit=2000).first()
    finally:
        q._inside = kept
    want = np.percentile([r.v for r in df.collect()], [25, 50, 75])
    assert np.allclose(got.quantiles, want) and len(seen) >= 3
    assert seen[-1].count() <= 3 * 2002


def test_kernel_stencil_equals_all_values_at_all_points(spark):
    """Far-apart clusters: most grid points get nothing, and none is missing."""
    rnd = np.random.default_rng(8)
    vs = np.concatenate([rnd.normal(0, 0.1, 500), rnd.normal(100, 0.1, 500), [1e4]])
    df = spark.createDataFrame([(float(v),) for v in vs], "v double")
    for options in ({}, {"cut": 3.0, "gridsize": 400}, {"bw_adjust": 0.01, "gridsize": 50}, {"bw_adjust": 1e-6}):
        got = sorted(ex.kde(df, "v", **options).collect(), key=lambda r: r.grid)
        n = options.get("gridsize", 200)
        h = np.std(vs, ddof=1) * len(vs) ** -0.2 * options.get("bw_adjust", 1.0)
        x = np.linspace(vs.min() - options.get("cut", 0) * h, vs.max() + options.get("cut", 0) * h, n)
        want = np.exp(-0.5 * ((x[:, None] - vs) / h) ** 2).sum(axis=1) / (len(vs) * h * np.sqrt(2 * np.pi))
        assert [r.grid for r in got] == list(range(n))
        assert np.allclose([r.density for r in got], want, rtol=1e-9, atol=1e-15 / h) or options.get("bw_adjust") == 1e-6


def test_auto_bins_keep_the_proved_bound(spark):
    rnd = np.random.default_rng(9)
    rows = [(g, float(v)) for g, vs in {"a": rnd.normal(0, 1, 3000), "b": rnd.exponential(5, 2000), None: rnd.uniform(-1, 1, 500)}.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    exact = {(r.g, r.grid): r for r in ex.kde(df, "v", "g").collect()}
    binned = {(r.g, r.grid): r for r in ex.kde(df, "v", "g", bins="auto").collect()}
    assert exact.keys() == binned.keys() and len(exact) == 600
    for k, r in exact.items():
        assert abs(r.density - binned[k].density) <= 0.4 / (8 * ex.FINE**2 * r.bandwidth) + 1e-12


def test_bootstrap_equals_multinomial_and_ignores_layout(spark):
    """Equal rows in bulk (zeros), values of one row, nulls; against numpy's resampling with replacement."""
    rnd = np.random.default_rng(4)
    vs = np.concatenate([np.zeros(2000), rnd.poisson(3, 1500).astype(float), rnd.normal(10, 4, 300)])
    rows = [("a", float(v)) for v in vs] + [("b", 2.0), (None, 1.0), (None, 5.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in ex.mean_ci(df, "k", "v", ci="bootstrap", n_boot=2000, seed=1).collect()}
    means = [rnd.choice(vs, len(vs)).mean() for _ in range(2000)]
    lo, hi = np.percentile(means, [2.5, 97.5])
    assert abs(got["a"].ci_lo - lo) < 0.1 * (hi - lo) and abs(got["a"].ci_hi - hi) < 0.1 * (hi - lo)
    assert got["b"].ci_lo == got["b"].ci_hi == 2.0 and 1.0 <= got[None].ci_lo <= got[None].ci_hi <= 5.0
    other = {r.k: r for r in ex.mean_ci(df.repartition(7, "v"), "k", "v", ci="bootstrap", n_boot=2000, seed=1).collect()}
    for k, r in got.items():
        assert (other[k].ci_lo, other[k].ci_hi) == pytest.approx((r.ci_lo, r.ci_hi), rel=1e-12)
    other = {r.k: r for r in ex.mean_ci(df, "k", "v", ci="bootstrap", n_boot=2000, seed=2).collect()}
    assert other["a"].ci_lo != got["a"].ci_lo


def test_binned_kde_close_to_exact(values):
    df, _ = values
    exact = {(r.g, r.grid): r.density for r in ex.kde(df, "v", "g").collect()}
    binned = {(r.g, r.grid): r.density for r in ex.kde(df, "v", "g", bins=2000).collect()}
    assert exact.keys() == binned.keys()
    peak = max(exact.values())
    assert max(abs(exact[k] - binned[k]) for k in exact) < 0.01 * peak


def test_kde_default_grid_spans_data(values):
    df, raw = values
    got = sorted(ex.kde(df, "v", "g").filter("g = 'b'").collect(), key=lambda r: r.grid)
    assert got[0].x == pytest.approx(raw["b"].min()) and got[-1].x == pytest.approx(raw["b"].max())
    v = ex.violin(df, "v", ["g"]).filter("g = 'b'").collect()
    assert len(v) == 100 and min(r.x for r in v) < raw["b"].min()


def test_histogram_value_on_inner_edge(spark):
    """A value exactly on an inner bin edge goes where numpy puts it (edge-corrected index)."""
    vals = [0.8, 2.24, -2.52, -0.27, 1.29, -3.52, 1.33, -0.36]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r["count"] for r in sorted(ex.histogram(df, "v").collect(), key=lambda r: r.bin)]
    counts, edges = np.histogram(np.array(vals), bins="auto")
    assert got == counts.tolist()
    lo = [r.bin_lo for r in sorted(ex.histogram(df, "v").collect(), key=lambda r: r.bin)]
    assert lo == edges[:-1].tolist()


def test_histogram_auto_classic_rule(spark):
    vals = [0.0, 0.0, 0.0, 0.0, 1.0]  # IQR 0: the current rule gives 5 bins, the classic one Sturges' 4
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    x = np.array(vals)
    sturges = np.ptp(x) / (np.log2(x.size) + 1.0)
    classic = int(np.ceil(np.ptp(x) / sturges))
    got = [r["count"] for r in sorted(ex.histogram(df, "v", bins="auto_classic").collect(), key=lambda r: r.bin)]
    assert len(got) == classic == 4 and sum(got) == 5
    assert len(ex.histogram(df, "v").collect()) == len(np.histogram_bin_edges(x, bins="auto")) - 1 == 5
    with pytest.raises(ValueError):
        ex.histogram(df, "v", bins="nope")
