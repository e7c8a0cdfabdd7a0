"""One-day-ahead trend + seasonal forecast for every (location, origin day).

The reference refits a per-series additive model (trend + seasonality) on all
rows up to each origin day d and predicts d + 1, one fit per row on the
driver. Here every origin is computed in one windowed pass:

* W1: expanding frame per location, ``RANGE UNBOUNDED PRECEDING .. CURRENT ROW``
  ordered by date (date ties all belong to the frame).
* trend: least-squares line of y on t (t = days since the location's first day)
  over the frame: ``regr_slope`` / ``regr_intercept``.
* seasonal terms (weekly by default, month-of-year optional): for the level L
  of d + 1 (its weekday / month), the mean residual of the frame's rows at that
  level, from running sums n_L, Σy_L, Σt_L: ``(Σy_L − a·n_L − b·Σt_L) / n_L``
  (0 when the frame has no row at that level).
* ``yhat(d + 1) = a + b·(t + 1) + Σ seasonal``; null below ``min_points``
  (or when all frame rows share one day, so no slope exists).

Running aggregates make each location O(n) instead of O(n²) refits, and the
frame only ever looks backwards, so no forecast uses data after its origin.
The window's input is the daily series (≤ one row per location and day plus
replays), so a task's share is bounded by the calendar, not by raw volume.
The pooled mode (``partition=[]``, the reference's ``'all'``) runs on per-day
sums instead of rows. Inputs: y = target with nulls → 0 (the reference's fill
before training).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.operators.prep import day_ahead

DEFAULT_VERSION = "trend_dow_v1"


def _expanding(partition: list[str]) -> Window:
    return (Window.partitionBy(*partition).orderBy("date")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))


# Seasonal terms: (level of a date, number of levels, name of the state column).
SEASONS = {
    "weekly": (F.dayofweek, 7, "weekday_effect"),   # 1 = Sunday … 7 = Saturday
    "yearly": (F.month, 12, "month_effect"),        # 1 = January … 12 = December
}


def _check_seasonality(seasonality) -> list[str]:
    names = list(seasonality)
    unknown = [x for x in names if x not in SEASONS]
    if unknown:
        raise ValueError(f"seasonality must be drawn from {sorted(SEASONS)} (got {unknown})")
    return names


def _season_sums(w: Window, seasons: list[str], weight, ysum: list) -> dict:
    """Running per-level weight, weighted-t and y sums for every seasonal term."""
    aggs = {}
    for name in seasons:
        level, n_levels, _ = SEASONS[name]
        lv = level(F.col("date"))
        for k in range(1, n_levels + 1):
            on = lv == k
            aggs[f"_n_{name}{k}"] = F.sum(F.when(on, weight).otherwise(F.lit(0.0))).over(w)
            aggs[f"_st_{name}{k}"] = F.sum(F.when(on, weight * F.col("t")).otherwise(F.lit(0.0))).over(w)
            for i, y in enumerate(ysum):
                aggs[f"_sy{i}_{name}{k}"] = F.sum(F.when(on, y).otherwise(F.lit(0.0))).over(w)
    return aggs


def _apply(d: DataFrame, targets: list[str], seasons: list[str], min_points: int, keep_state: bool,
           ab: dict) -> DataFrame:
    """yhat (and optionally the state) from the running sums: trend + Σ seasonal mean residuals."""
    out = {}
    for i, tg in enumerate(targets):
        a, b = ab[i]
        yhat = a + b * (F.col("t") + 1)
        for name in seasons:
            level, n_levels, state = SEASONS[name]
            nxt = level(F.date_add(F.col("date"), 1))

            def pick(prefix: str, name=name, n_levels=n_levels, nxt=nxt):
                return F.element_at(F.array(*[F.col(f"{prefix}{k}") for k in range(1, n_levels + 1)]), nxt)

            nk, stk, syk = pick(f"_n_{name}"), pick(f"_st_{name}"), pick(f"_sy{i}_{name}")
            yhat = yhat + F.when(nk > 0, (syk - a * nk - b * stk) / nk).otherwise(F.lit(0.0))
            if keep_state:
                out[f"{state}_{tg}"] = F.array(*[
                    F.when(F.col(f"_n_{name}{k}") > 0,
                           (F.col(f"_sy{i}_{name}{k}") - a * F.col(f"_n_{name}{k}") - b * F.col(f"_st_{name}{k}"))
                           / F.col(f"_n_{name}{k}"))
                    for k in range(1, n_levels + 1)])
        out[f"yhat_{tg}"] = F.when(F.col("n_obs") >= min_points, yhat)
        if keep_state:
            out[f"intercept_{tg}"] = a
            out[f"slope_{tg}"] = b
    return d.withColumns(out)


def _frame(partition: list[str], history_days: int | None) -> Window:
    """The fitting frame: expanding, or the trailing ``history_days`` calendar days."""
    if not history_days:
        return _expanding(partition)
    if history_days < 1:
        raise ValueError("history_days must be ≥ 1")
    return (Window.partitionBy(*partition).orderBy("_dn")
            .rangeBetween(-(int(history_days) - 1), Window.currentRow))


def forecast_frame(obs: DataFrame, target: str | list[str] = "new_cases",
                   partition: list[str] | None = None, min_points: int = 2,
                   keep_state: bool = False, seasonality: tuple[str, ...] = ("weekly",),
                   history_days: int | None = None) -> DataFrame:
    """All columns of ``obs`` plus ``t``, the frame size ``n_obs`` and ``yhat_<target>``.

    Several targets share one window (same partitioning, order and frame), so
    forecasting cases, deaths and vaccinations costs one shuffle and one sort.
    ``partition`` defaults to ``["location"]``; pass ``[]`` for one pooled series.
    ``seasonality``: ``("weekly",)`` (default) or ``("weekly", "yearly")`` — each
    term adds, for the target day's level (weekday / month), the mean residual
    of the frame's rows at that level around the trend (0 for an unseen level).
    ``keep_state`` also returns each origin's fitted state per target:
    ``intercept_<t>``, ``slope_<t>``, ``weekday_effect_<t>`` (7 values, Sunday
    first) and, with the yearly term, ``month_effect_<t>`` (12); null for a level
    not yet seen.
    ``history_days=k`` fits on the trailing k calendar days only (days d − k + 1 … d)
    instead of the whole history: a recent-trend model for series whose trend
    changes (one extra sort, on the integer day number).
    """
    targets = [target] if isinstance(target, str) else list(target)
    for tg in targets:
        if tg not in obs.columns:
            raise ValueError(f"target column {tg!r} not in input")
    seasons = _check_seasonality(seasonality)
    part = ["location"] if partition is None else list(partition)
    if not part:
        return _pooled_frame(obs, targets, min_points, keep_state, seasons, history_days)
    d = obs.withColumn("t", F.datediff(F.col("date"), F.first(F.col("date")).over(_expanding(part)))
                       .cast("double"))
    if history_days:
        d = d.withColumn("_dn", F.unix_date(F.col("date")))
    w = _frame(part, history_days)
    ys = [F.coalesce(F.col(tg).cast("double"), F.lit(0.0)) for tg in targets]
    d = d.withColumns({f"_y{i}": y for i, y in enumerate(ys)})
    ycols = [F.col(f"_y{i}") for i in range(len(targets))]
    aggs = {"n_obs": F.count(F.lit(1)).over(w)}
    for i, y in enumerate(ycols):
        aggs[f"_b{i}"] = F.regr_slope(y, F.col("t")).over(w)
        aggs[f"_a{i}"] = F.regr_intercept(y, F.col("t")).over(w)
    aggs.update(_season_sums(w, seasons, F.lit(1.0), ycols))
    d = d.withColumns(aggs)
    d = _apply(d, targets, seasons, min_points, keep_state,
               {i: (F.col(f"_a{i}"), F.col(f"_b{i}")) for i in range(len(targets))})
    return d.drop(*[k for k in aggs if k.startswith("_")], *[f"_y{i}" for i in range(len(targets))], "_dn")


def _pooled_frame(obs: DataFrame, targets: list[str], min_points: int, keep_state: bool,
                  seasons: list[str] = ("weekly",), history_days: int | None = None) -> DataFrame:
    # one row per distinct day: bounded by the calendar
    days = _pooled_days(obs, targets, min_points, keep_state, seasons, history_days)
    return obs.join(F.broadcast(days), "date", "left")


def _pooled_days(obs: DataFrame, targets: list[str], min_points: int, keep_state: bool,
                 seasons: list[str] = ("weekly",), history_days: int | None = None) -> DataFrame:
    """One series pooled over all rows (the reference's ``'all'`` mode, Q7).

    The least-squares line over all rows dated ≤ d only needs per-day sums
    (count, Σy), so rows are first reduced to one row per day (partial
    aggregation), the expanding sums run over days — a window whose input is
    bounded by the calendar, not by the row count — and the per-day forecasts
    (one row per day) are broadcast back to the rows.
    """
    ys = {f"_s{i}": F.sum(F.coalesce(F.col(tg).cast("double"), F.lit(0.0))) for i, tg in enumerate(targets)}
    day = obs.groupBy("date").agg(F.count(F.lit(1)).cast("double").alias("_c"), *[v.alias(k) for k, v in ys.items()])
    day = day.withColumn("t", F.datediff(F.col("date"), F.first(F.col("date")).over(_expanding([])))
                         .cast("double"))
    if history_days:
        day = day.withColumn("_dn", F.unix_date(F.col("date")))
    w = _frame([], history_days)
    c, t = F.col("_c"), F.col("t")
    sums = {"n_obs": F.sum(c).over(w), "_St": F.sum(c * t).over(w), "_Stt": F.sum(c * t * t).over(w)}
    for i in range(len(targets)):
        sums[f"_Sy{i}"] = F.sum(F.col(f"_s{i}")).over(w)
        sums[f"_Sty{i}"] = F.sum(t * F.col(f"_s{i}")).over(w)
    sums.update(_season_sums(w, seasons, c, [F.col(f"_s{i}") for i in range(len(targets))]))
    day = day.withColumns(sums)
    n, st, stt = F.col("n_obs"), F.col("_St"), F.col("_Stt")
    ab = {}
    for i in range(len(targets)):
        b = (n * F.col(f"_Sty{i}") - st * F.col(f"_Sy{i}")) / F.nullif(n * stt - st * st, F.lit(0.0))
        ab[i] = ((F.col(f"_Sy{i}") - b * st) / n, b)
    day = _apply(day, targets, seasons, min_points, keep_state, ab)
    keep = [c for c in day.columns if not c.startswith("_") and c not in ("n_obs",)]
    return day.select(*keep, F.col("n_obs").cast("long").alias("n_obs"))


def model_state(obs: DataFrame, targets: list[str] | None = None, model_version: str = DEFAULT_VERSION,
                partition: list[str] | None = None, seasonality: tuple[str, ...] = ("weekly",),
                history_days: int | None = None) -> DataFrame:
    """The windowed model as a table: one row per (location, origin) with its
    fitted trend and weekday effects per target (S11 for the windowed model,
    written with ``sinks.tables.write_coefficients``)."""
    targets = targets or ["new_cases"]
    keys = ["location"] if partition is None else list(partition)
    seasons = _check_seasonality(seasonality)
    f = (forecast_frame(obs, targets, partition, keep_state=True, seasonality=tuple(seasons),
                        history_days=history_days) if keys
         else _pooled_days(obs, targets, 2, True, seasons, history_days))
    cols = [c for tg in targets for c in
            [f"intercept_{tg}", f"slope_{tg}"] + [f"{SEASONS[nm][2]}_{tg}" for nm in seasons]]
    return f.select(*keys, "date", F.lit(model_version).alias("model_version"), "n_obs", "t", *cols)


def forecast(obs: DataFrame, target: str = "new_cases", model_version: str = DEFAULT_VERSION,
             min_points: int = 2, missing: str = "null", partition: list[str] | None = None,
             seasonality: tuple[str, ...] = ("weekly",), history_days: int | None = None) -> DataFrame:
    """One row per input row: (location, date, target_date, model_version, <target>_predicted).

    ``missing="zero"`` reproduces the reference's "failed / NaN forecast → 0" (P13);
    the default keeps null so metrics skip it.
    """
    d = forecast_frame(obs, target, partition, min_points, seasonality=seasonality, history_days=history_days)
    p = F.col(f"yhat_{target}")
    if missing == "zero":
        p = F.coalesce(F.nanvl(p, F.lit(0.0)), F.lit(0.0))
    elif missing != "null":
        raise ValueError("missing must be 'null' or 'zero'")
    return d.select("location", "date", F.date_add("date", 1).alias("target_date"),
                    F.lit(model_version).alias("model_version"),
                    p.alias(f"{target}_predicted"))


def forecast_with_actuals(obs: DataFrame, target: str = "new_cases", align: str = "target",
                          model_version: str = DEFAULT_VERSION, min_points: int = 2,
                          seasonality: tuple[str, ...] = ("weekly",)) -> DataFrame:
    """Forecast plus the actual it is judged against, in the same window pass.

    ``align="target"``: actual of d + 1 (null when that day has no row: calendar gap).
    ``align="origin"``: actual of d itself — the reference's stored pairing (Q1).
    Actuals get the reference's null → 0 fill when their row exists.
    """
    d = forecast_frame(obs, target, None, min_points, seasonality=seasonality)
    y = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    if align == "target":
        actual = day_ahead(f"first(coalesce(cast(`{target}` as double), 0.0D))")
    elif align == "origin":
        actual = y
    else:
        raise ValueError("align must be 'target' or 'origin'")
    return d.select("location", "date", F.date_add("date", 1).alias("target_date"),
                    F.lit(model_version).alias("model_version"),
                    F.col(f"yhat_{target}").alias(f"{target}_predicted"),
                    actual.alias(f"{target}_actual"))
