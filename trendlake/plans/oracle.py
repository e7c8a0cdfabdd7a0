"""Independent SQL for each registered query (DuckDB dialect, tables as views).

Written as plain relational SQL — range self-joins instead of running
windows, grouped aggregates, explicit joins — rather than as translations of
the Spark plans, so the check compares two formulations of the same semantics.
Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from trendlake.schema import CORR_COLUMNS
from trendlake.sources.tables import observations_sql

SQL: dict[str, str] = {}

OBS_CTE = f"obs as (select * from ({observations_sql()}) x)"

# null → 0 on every numeric column, as the backtest prepares its input
POBS_CTE = """pobs as (
  select location, date,
         coalesce(new_cases, 0) as new_cases, coalesce(new_deaths, 0) as new_deaths,
         coalesce(new_vaccinations, 0) as new_vaccinations,
         coalesce(total_cases, 0) as total_cases, coalesce(total_deaths, 0) as total_deaths,
         coalesce(life_expectancy, 0) as life_expectancy, coalesce(excess_mortality, 0) as excess_mortality
  from obs)"""


def _forecast_ctes(src: str, targets: list[str], tag: str, window_days: int | None = None) -> str:
    """CTEs ``s_{tag}``, ``fit_{tag}``, ``seas_{tag}`` and ``fc_{tag}`` (yhat per target).

    ``window_days``: fit on the trailing days d − window_days + 1 … d only."""
    lo_i = f" and j.date >= cast(i.date - {int(window_days) - 1} as date)" if window_days else ""
    lo_f = f" and j.date >= cast(f.date - {int(window_days) - 1} as date)" if window_days else ""
    ys = ", ".join(f"coalesce({t}, 0) as y{i}" for i, t in enumerate(targets))
    fits = ", ".join(f"regr_slope(j.y{i}, j.t) as b{i}, regr_intercept(j.y{i}, j.t) as a{i}"
                     for i in range(len(targets)))
    seas = ", ".join(f"avg(j.y{i} - f.a{i} - f.b{i} * j.t) as z{i}" for i in range(len(targets)))
    yh = ", ".join(f"case when f.n >= 2 then f.a{i} + f.b{i} * (f.t + 1) + coalesce(z.z{i}, 0) end as yhat_{t}"
                   for i, t in enumerate(targets))
    return f"""
s_{tag} as (
  select location, date, {ys},
         cast(date_diff('day', min(date) over (partition by location), date) as double) as t
  from {src}),
fit_{tag} as (
  select i.location, i.date, i.t, count(*) as n, {fits}
  from s_{tag} i join s_{tag} j on i.location = j.location and j.date <= i.date{lo_i}
  group by i.location, i.date, i.t),
seas_{tag} as (
  select f.location, f.date, {seas}
  from fit_{tag} f join s_{tag} j on f.location = j.location and j.date <= f.date{lo_f}
                     and dayofweek(j.date) = dayofweek(cast(f.date + 1 as date))
  group by f.location, f.date),
fc_{tag} as (
  select f.location, f.date, cast(f.date + 1 as date) as target_date,
         'trend_dow_v1' as model_version, {yh}
  from fit_{tag} f left join seas_{tag} z on f.location = z.location and f.date = z.date)"""


PRED_CTE = f"""{OBS_CTE}, {POBS_CTE}, {_forecast_ctes('pobs', ['new_cases', 'new_deaths', 'new_vaccinations'], 'p')},
pred as (
  select f.location, f.date,
         f.yhat_new_cases as new_cases_predicted, f.yhat_new_deaths as new_deaths_predicted,
         f.yhat_new_vaccinations as new_vaccinations_predicted,
         p.new_cases as new_cases_actual, p.new_deaths as new_deaths_actual,
         p.new_vaccinations as new_vaccinations_actual,
         p.total_cases, p.total_deaths, p.life_expectancy, p.excess_mortality,
         f.model_version, cast(null as date) as created_at, f.target_date,
         cast(null as date) as model_cutoff
  from fc_p f join pobs p on p.location = f.location and p.date = f.date)"""

# actual of the target day, from the row of the next origin (same location and model)
ALIGNED_CTE = """aligned as (
  select a.location, a.date, a.model_version,
         a.new_cases_predicted, a.new_deaths_predicted, a.new_vaccinations_predicted,
         b.new_cases_actual, b.new_deaths_actual, b.new_vaccinations_actual
  from pred a left join pred b on a.location = b.location and a.model_version = b.model_version
                              and b.date = cast(a.date + 1 as date))"""


def _r(x: str, alias: str) -> str:
    return f"round({x}, 6) as {alias}"


def _metrics_sql(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    tall = " union all ".join(
        f"select {k}, '{t}' as target, {t}_actual as actual, {t}_predicted as predicted from {src}"
        for t in ("new_cases", "new_deaths", "new_vaccinations"))
    return f"""
select {k}, target, cast(count(*) as bigint) as n,
       {_r('sqrt(avg(power(actual - predicted, 2)))', 'rmse')},
       {_r('avg(abs(actual - predicted))', 'mae')},
       {_r('1 - sum(power(actual - predicted, 2)) / nullif(regr_syy(actual, predicted), 0)', 'r2')}
from ({tall}) t
where actual is not null and predicted is not null
group by {k}, target"""


# ----------------------------------------------------------- series, forecast
SQL["daily_series"] = f"""
with {OBS_CTE}
select location, date, total_cases, new_cases, total_deaths, new_deaths, total_vaccinations,
       people_vaccinated, people_fully_vaccinated, new_vaccinations,
       round(life_expectancy, 6) as life_expectancy, round(excess_mortality, 6) as excess_mortality
from obs"""

SQL["forecast_cases"] = f"""
with {OBS_CTE}, {_forecast_ctes('obs', ['new_cases'], 'c')}
select location, date, target_date, model_version, round(yhat_new_cases, 6) as new_cases_predicted from fc_c"""

SQL["forecast_deaths"] = f"""
with {OBS_CTE}, {_forecast_ctes('obs', ['new_deaths'], 'd')}
select location, date, target_date, model_version, round(yhat_new_deaths, 6) as new_deaths_predicted from fc_d"""


def _eval_sql(join_day: str) -> str:
    return f"""
with {OBS_CTE}, {_forecast_ctes('obs', ['new_cases'], 'c')},
pairs as (
  select f.location, f.model_version, f.yhat_new_cases as p, coalesce(o.new_cases, 0) as a
  from fc_c f join obs o on o.location = f.location and o.date = f.{join_day}
  where f.yhat_new_cases is not null)
select location, model_version, cast(count(*) as bigint) as n,
       round(sqrt(avg(power(a - p, 2))), 6) as rmse,
       round(avg(abs(a - p)), 6) as mae,
       round(1 - sum(power(a - p, 2)) / nullif(regr_syy(a, p), 0), 6) as r2,
       'new_cases' as target
from pairs group by location, model_version"""


SQL["forecast_eval_target"] = _eval_sql("target_date")
SQL["forecast_eval_origin"] = _eval_sql("date")

# ------------------------------------------------------------------ prep
SQL["fill_nulls"] = f"""
with {OBS_CTE}
select location, date,
       coalesce(total_cases, 0) as total_cases, coalesce(new_cases, 0) as new_cases,
       coalesce(total_deaths, 0) as total_deaths, coalesce(new_deaths, 0) as new_deaths,
       coalesce(total_vaccinations, 0) as total_vaccinations,
       coalesce(people_vaccinated, 0) as people_vaccinated,
       coalesce(people_fully_vaccinated, 0) as people_fully_vaccinated,
       coalesce(new_vaccinations, 0) as new_vaccinations,
       round(coalesce(life_expectancy, 0), 6) as life_expectancy,
       round(coalesce(excess_mortality, 0), 6) as excess_mortality
from obs"""

SQL["next_day_join"] = f"""
with {OBS_CTE}
select a.location, a.date, a.new_cases, b.location is not null as next_exists,
       b.new_cases as next_new_cases, b.new_deaths as next_new_deaths
from obs a left join obs b on a.location = b.location and b.date = cast(a.date + 1 as date)"""

# ------------------------------------------------------------- predictions
SQL["predictions_w2"] = f"""
with {PRED_CTE}
select location, date,
       {_r('new_cases_predicted', 'new_cases_predicted')},
       {_r('new_deaths_predicted', 'new_deaths_predicted')},
       {_r('new_vaccinations_predicted', 'new_vaccinations_predicted')},
       new_cases_actual, new_deaths_actual, new_vaccinations_actual, total_cases, total_deaths,
       {_r('life_expectancy', 'life_expectancy')}, {_r('excess_mortality', 'excess_mortality')},
       model_version, target_date
from pred"""

SQL["eval_by_model"] = f"with {PRED_CTE}, {ALIGNED_CTE} {_metrics_sql('aligned', ['model_version'])}"
SQL["eval_by_location_origin"] = f"with {PRED_CTE} {_metrics_sql('pred', ['location', 'model_version'])}"

SQL["error_series"] = f"""
with {PRED_CTE}, {ALIGNED_CTE}
select location, date, model_version,
       {_r('new_cases_predicted - new_cases_actual', 'cases_error')},
       {_r('new_deaths_predicted - new_deaths_actual', 'deaths_error')}
from aligned"""

# ------------------------------------------------------------------ explore
SQL["locations"] = f"with {PRED_CTE} select distinct location from pred where location is not null"

_DESCRIBE_COLS = ["new_cases_predicted", "new_deaths_predicted", "new_vaccinations_predicted",
                  "new_cases_actual", "new_deaths_actual", "new_vaccinations_actual",
                  "total_cases", "total_deaths", "life_expectancy", "excess_mortality"]
SQL["describe_predictions"] = f"with {PRED_CTE} " + " union all ".join(
    f"""select '{c}' as metric, count({c}) as count, {_r(f'avg({c})', 'mean')}, {_r(f'stddev_samp({c})', 'std')},
       {_r(f'min({c})', 'min')}, {_r(f'quantile_cont({c}, 0.25)', 'q25')}, {_r(f'quantile_cont({c}, 0.5)', 'q50')},
       {_r(f'quantile_cont({c}, 0.75)', 'q75')}, {_r(f'max({c})', 'max')} from pred"""
    for c in _DESCRIBE_COLS)

SQL["location_stats"] = f"""
with {PRED_CTE}
select location,
       {_r('avg(new_cases_actual)', 'new_cases_actual_mean')},
       {_r('stddev_samp(new_cases_actual)', 'new_cases_actual_std')},
       {_r('max(new_cases_actual)', 'new_cases_actual_max')},
       {_r('avg(new_deaths_actual)', 'new_deaths_actual_mean')},
       {_r('stddev_samp(new_deaths_actual)', 'new_deaths_actual_std')},
       {_r('max(new_deaths_actual)', 'new_deaths_actual_max')},
       {_r('max_by(total_cases, date) filter (where total_cases is not null)', 'total_cases_last')},
       {_r('max_by(total_deaths, date) filter (where total_deaths is not null)', 'total_deaths_last')},
       {_r('avg(life_expectancy)', 'life_expectancy_mean')},
       {_r('avg(excess_mortality)', 'excess_mortality_mean')}
from pred group by location"""


def _corr_sql() -> str:
    cols = CORR_COLUMNS
    aggs, rows = [], []
    for i, x in enumerate(cols):
        for j in range(i, len(cols)):
            y = cols[j]
            aggs.append(f"regr_sxy({y}, {x}) / nullif(sqrt(regr_sxx({y}, {x}) * regr_syy({y}, {x})), 0) as r{i}_{j}")
            rows.append(f"select '{x}' as row_metric, '{y}' as col_metric, round(r{i}_{j}, 6) as corr from w")
            if i != j:
                rows.append(f"select '{y}' as row_metric, '{x}' as col_metric, round(r{i}_{j}, 6) as corr from w")
    return f"with {PRED_CTE}, w as (select {', '.join(aggs)} from pred) " + " union all ".join(rows)


SQL["corr_matrix"] = _corr_sql()


def _mean_ci_sql(src_cte: str, src: str, keys: list[str], y: str) -> str:
    k = ", ".join(keys)
    return f"""
with {src_cte} g as (select {k}, count({y}) as n, avg({y}) as mean, stddev_samp({y}) as std
                      from {src} group by {k})
select {k}, n, round(mean, 6) as mean, round(std, 6) as std,
       round(mean - 1.96 * std / sqrt(n), 6) as ci_lo, round(mean + 1.96 * std / sqrt(n), 6) as ci_hi
from g"""


SQL["compare_locations"] = _mean_ci_sql(f"{PRED_CTE},", "pred", ["date", "location"], "excess_mortality")
SQL["mean_ci_by_date"] = _mean_ci_sql(
    "e as (select cast(ts as date) as day, event_type, value from events),", "e", ["day", "event_type"], "value")
SQL["bar_by_segment"] = _mean_ci_sql("", "customer", ["c_mktsegment"], "c_acctbal")


def _hist_sql(src_cte: str, hue: str | None, bins: str | int, digits: int = 6) -> str:
    hk = f"{hue}, " if hue else ""
    if bins == "auto":
        nb = """cast(case when w > 0 then ceil((hi - lo) / w) else 1 end as int)"""
        st = """st as (select count(x) as n, min(x) as mn, max(x) as mx,
                      quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.75) as q3 from d),
st2 as (select *, case when mx - mn = 0 then mn - 0.5 else mn end as lo,
                  case when mx - mn = 0 then mx + 0.5 else mx end as hi,
                  (mx - mn) / (log2(n) + 1.0) as sturges,
                  2.0 * (q3 - q1) * power(n, -1.0 / 3.0) as fd,
                  (mx - mn) / sqrt(n) as sq from st),
st3 as (select lo, hi, least(greatest(fd, sq / 2.0), sturges) as w from st2)"""
    else:
        nb = f"{int(bins)}"
        st = """st as (select min(x) as mn, max(x) as mx from d),
st3 as (select case when mx - mn = 0 then mn - 0.5 else mn end as lo,
               case when mx - mn = 0 then mx + 0.5 else mx end as hi from st)"""
    return f"""
with {src_cte}, {st},
st4 as (select lo, hi, {nb} as nb from st3),
b0 as (select {hk}x, lo, hi, nb, least(cast(floor((x - lo) * (nb / (hi - lo))) as int), nb - 1) as i0
       from d join st4 on true),
b1 as (select *, case when x < (case when i0 >= nb then hi else i0 * ((hi - lo) / nb) + lo end)
                      then i0 - 1 else i0 end as i1 from b0),
b as (select {hk}case when x >= (case when i1 + 1 >= nb then hi else (i1 + 1) * ((hi - lo) / nb) + lo end)
                           and i1 <> nb - 1 then i1 + 1 else i1 end as bin from b1),
c as (select {hk}bin, count(*) as n from b group by {hk}bin),
lv as ({'select distinct ' + hue + ' from d' if hue else 'select 1 as one'}),
allb as (select {'lv.' + hue + ', ' if hue else ''}cast(unnest(range(0, st4.nb)) as int) as bin, st4.lo, st4.hi, st4.nb
         from lv join st4 on true)
select {'allb.' + hue + ', ' if hue else ''}allb.bin,
       round(case when allb.bin >= nb then hi else allb.bin * ((hi - lo) / nb) + lo end, {digits}) as bin_lo,
       round(case when allb.bin + 1 >= nb then hi else (allb.bin + 1) * ((hi - lo) / nb) + lo end, {digits}) as bin_hi,
       cast(coalesce(c.n, 0) as bigint) as count
from allb left join c on allb.bin = c.bin{' and allb.' + hue + ' is not distinct from c.' + hue if hue else ''}"""


SQL["hist_events"] = _hist_sql(
    "d as (select event_type, value as x from events where value is not null and not isnan(value))",
    "event_type", "auto")
SQL["hist_errors"] = _hist_sql(
    f"{PRED_CTE}, {ALIGNED_CTE}, d as (select new_cases_predicted - new_cases_actual as x from aligned "
    "where new_cases_predicted - new_cases_actual is not null)", None, 20)

_EV_D = "d as (select event_type, value as x from events where value is not null and not isnan(value))"
def _kde_sql(cut: float, gridsize: int) -> str:
    return f"""
st as (select event_type, count(x) as n, stddev_samp(x) * power(count(x), -0.2) * 1.0 as h,
              min(x) as mn, max(x) as mx from d group by event_type),
g as (select event_type, n, h, mn - {cut} * h as lo, (mx + {cut} * h - (mn - {cut} * h)) / {gridsize - 1} as step
      from st where h > 0),
v as (select event_type, x, count(*) as c from d group by event_type, x),
k as (select g.event_type, t.grid, g.n, g.h, g.lo, g.step,
             sum(v.c * exp(-0.5 * power((g.lo + t.grid * g.step - v.x) / g.h, 2))) as s
      from g join v on g.event_type = v.event_type join range(0, {gridsize}) t(grid) on true
      group by g.event_type, t.grid, g.n, g.h, g.lo, g.step),
kde as (select event_type, cast(grid as int) as grid, lo + grid * step as x,
               s / (n * h * sqrt(2 * pi())) as density, h as bandwidth from k)"""


_KDE = _kde_sql(0.0, 200)
SQL["kde_events"] = f"""with {_EV_D}, {_KDE}
select event_type, grid, round(x, 6) as x, round(density, 6) as density, round(bandwidth, 6) as bandwidth from kde"""

_BALANCE = _kde_sql(0.0, 200).replace("event_type", "c_mktsegment")
_BALANCE_D = "d as (select c_mktsegment, c_acctbal as x from customer where c_acctbal is not null)"
SQL["kde_balance"] = f"""with {_BALANCE_D}, {_BALANCE}
select c_mktsegment, grid, round(x, 6) as x, round(density * 1e6, 6) as density_per_million, round(bandwidth, 6) as bandwidth from kde"""

# the binned curve itself is not SQL's business; that it keeps within the proved bound is claimed
SQL["kde_balance_binned"] = f"""with {_BALANCE_D}, {_BALANCE}
select c_mktsegment, count(*) as points, round(max(bandwidth), 6) as bandwidth, true as within from kde group by c_mktsegment"""

_BOX = """
q as (select event_type, count(x) as n, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median,
             quantile_cont(x, 0.75) as q3 from d group by event_type),
f as (select *, q1 - 1.5 * (q3 - q1) as lo_f, q3 + 1.5 * (q3 - q1) as hi_f from q)"""
SQL["box_events"] = f"""with {_EV_D}, {_BOX}
select f.event_type, f.n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
       round(min(case when x >= lo_f then x end), 6) as whisker_lo,
       round(max(case when x <= hi_f then x end), 6) as whisker_hi,
       count(case when x < lo_f or x > hi_f then 1 end) as n_outliers
from d join f on d.event_type is not distinct from f.event_type
group by f.event_type, f.n, q1, median, q3"""

SQL["violin_events"] = f"""with {_EV_D}, {_kde_sql(2.0, 100)}, {_BOX}
select kde.event_type, grid, round(x, 6) as x, round(density, 6) as density, round(bandwidth, 6) as bandwidth,
       round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3
from kde join q on kde.event_type = q.event_type"""

_LABELS = {"new_cases_actual": "New Cases Actual", "new_deaths_actual": "New Deaths Actual",
           "total_cases": "Total Cases", "total_deaths": "Total Deaths",
           "new_vaccinations_actual": "New Vaccinations Actual", "excess_mortality": "Excess Mortality"}
SQL["metric_series"] = f"with {PRED_CTE} " + " union all ".join(
    f"select location, date, '{m}' as metric, round({m}, 6) as value, '{lab}' as label from pred"
    for m, lab in _LABELS.items())

SQL["area_series"] = f"with {PRED_CTE} select location, date, total_cases from pred"

# ------------------------------------------------------ ingest, sources, sinks
_OBS_OUT = """
select location, date, total_cases, new_cases, total_deaths, new_deaths, total_vaccinations,
       people_vaccinated, people_fully_vaccinated, new_vaccinations,
       round(life_expectancy, 6) as life_expectancy, round(excess_mortality, 6) as excess_mortality
from obs"""
SQL["parse_messages"] = f"with {OBS_CTE} {_OBS_OUT}"
SQL["stream_ingest"] = f"with {OBS_CTE} {_OBS_OUT}"
SQL["csv_roundtrip"] = f"with {OBS_CTE} {_OBS_OUT}"
SQL["predictions_store"] = SQL["predictions_w2"]
SQL["predictions_store_by_location"] = SQL["predictions_w2"]
SQL["stream_ingest_twice"] = f"""
with {OBS_CTE}, o as ({_OBS_OUT})
select *, 'plain' as mode from o union all select *, 'quarantine' as mode from o"""
SQL["stream_ingest_malformed"] = f"""
with {OBS_CTE}, o as ({_OBS_OUT})
select location, date, case when day(date) <> 2 then new_cases end as new_cases, total_cases, 'table' as store, cast(1 as bigint) as n
from o where day(date) not in (1, 3)
union all
select case when day(date) = 1 then null else location end, null, null, null, 'quarantine', count(*)
from o where day(date) <= 3 group by 1"""

SQL["rf_deaths_frame"] = f"""
with {OBS_CTE},
o as (select location, date, coalesce(new_cases, 0) as new_cases, coalesce(new_deaths, 0) as new_deaths from obs),
span as (select min(date) as lo, max(date) as hi from o),
yearly as (select make_date(y, 1, 1) as c from span, generate_series(year(lo) + 1, year(hi)) t(y)),
early as (select cast(lo + n as date) as c from span, (values (1), (30), (182)) t(n)
          where cast(lo + n as date) < coalesce((select min(c) from yearly), date '9999-01-01')),
cuts as (select c from yearly union select c from early),
labelled as (select min(b.date) as d from o a join o b on a.location = b.location and b.date = a.date + 1),
m as (select location, date, new_cases, new_deaths, (select max(c) from cuts where c <= date) as c from o)
select location, date, cast(date + 1 as date) as target_date, c as model_cutoff, new_cases as new_cases_actual,
       new_deaths as new_deaths_actual, coalesce(c >= (select d from labelled), false) as predicted
from m"""

SQL["forecast_pooled"] = f"""
with {OBS_CTE},
s as (select date, coalesce(new_cases, 0) as y,
             cast(date_diff('day', min(date) over (), date) as double) as t from obs),
d as (select distinct date, t from s),
fit as (
  select i.date, i.t, count(*) as n, regr_slope(j.y, j.t) as b, regr_intercept(j.y, j.t) as a
  from d i join s j on j.date <= i.date group by i.date, i.t),
seas as (
  select f.date, avg(j.y - f.a - f.b * j.t) as z
  from fit f join s j on j.date <= f.date and dayofweek(j.date) = dayofweek(cast(f.date + 1 as date))
  group by f.date),
pf as (
  select f.date, case when f.n >= 2 then f.a + f.b * (f.t + 1) + coalesce(z.z, 0) end as yhat
  from fit f left join seas z on f.date = z.date)
select o.location, o.date, cast(o.date + 1 as date) as target_date, 'trend_dow_v1' as model_version,
       round(pf.yhat, 6) as new_cases_predicted
from obs o join pf on o.date = pf.date"""

SQL["predictions_reference_mode"] = f"""
with {PRED_CTE}
select location, date,
       {_r('coalesce(new_cases_predicted, 0)', 'new_cases_predicted')},
       cast(null as double) as new_deaths_predicted,
       cast(0 as double) as new_vaccinations_predicted,
       new_cases_actual, new_deaths_actual, new_vaccinations_actual, total_cases, total_deaths,
       {_r('life_expectancy', 'life_expectancy')}, {_r('excess_mortality', 'excess_mortality')},
       model_version, target_date
from pred"""

SQL["forecast_cases_yearly"] = f"""
with {OBS_CTE}, {_forecast_ctes('obs', ['new_cases'], 'c')},
mon as (
  select f.location, f.date, avg(j.y0 - f.a0 - f.b0 * j.t) as zm
  from fit_c f join s_c j on f.location = j.location and j.date <= f.date
                       and month(j.date) = month(cast(f.date + 1 as date))
  group by f.location, f.date)
select f.location, f.date, f.target_date, f.model_version,
       round(f.yhat_new_cases + coalesce(m.zm, 0), 6) as new_cases_predicted
from fc_c f left join mon m on f.location = m.location and f.date = m.date"""

SQL["eval_reference_mode"] = f"""
with {PRED_CTE},
ref as (select location, date, model_version,
               coalesce(new_cases_predicted, 0) as new_cases_predicted,
               cast(null as double) as new_deaths_predicted,
               cast(0 as double) as new_vaccinations_predicted,
               new_cases_actual, new_deaths_actual, new_vaccinations_actual from pred)
{_metrics_sql('ref', ['model_version'])}"""



# ------------------------------------------------------------- dashboard analyses
SQL["filter_location"] = f"""with {OBS_CTE} select location, date, new_cases from obs
where location in ('CANADA', 'MOROCCO', 'NATION_0', 'NATION_1')"""
SQL["actual_vs_predicted"] = f"""with {PRED_CTE}
select date, model_version, new_cases_actual as actual, round(new_cases_predicted, 6) as predicted from pred
where location = (select min(location) from pred) and new_cases_actual is not null and new_cases_predicted is not null"""


def _date_stat(expr: str, name: str) -> str:
    # a fractional day number as a time of day
    return f"strftime(timestamp '1970-01-01' + to_seconds(cast(round(({expr}) * 86400) as bigint)), '%Y-%m-%d %H:%M:%S') as {name}"


SQL["describe_dates"] = f"with {PRED_CTE}, n as (select date - date '1970-01-01' as a, target_date - date '1970-01-01' as b from pred) " + \
    " union all ".join(f"select '{name}' as metric, count({c}) as count, " + ", ".join(
        _date_stat(e, o) for e, o in ((f"min({c})", "min"), (f"quantile_cont({c}, 0.25)", "q25"),
                                      (f"quantile_cont({c}, 0.5)", "q50"), (f"quantile_cont({c}, 0.75)", "q75"),
                                      (f"max({c})", "max"))) + " from n"
                       for name, c in (("date", "a"), ("target_date", "b")))
SQL["compare_metric"] = f"""with {PRED_CTE}
select date, location, count(excess_mortality) as n, round(avg(excess_mortality), 6) as mean, 'Excess Mortality' as label
from pred group by date, location"""
SQL["error_distribution"] = f"""with {PRED_CTE}, {ALIGNED_CTE},
d as (select 'all' as event_type, new_cases_predicted - new_cases_actual as x from aligned
      where new_cases_predicted - new_cases_actual is not null), {_kde_sql(0.0, 200)}
select grid, round(x, 6) as x, round(density, 6) as density, round(bandwidth, 6) as bandwidth from kde"""
SQL["chart_histogram_kde"] = f"""with h as ({_hist_sql(_EV_D, "event_type", "auto", 15)}),
curve as (with {_EV_D}, {_kde_sql(0.0, 200)} select * from kde),
s as (select event_type, sum(count) * max(bin_hi - bin_lo) as scale from h group by event_type)
select event_type, 'bar' as part, bin as i, round(bin_lo, 6) as lo, round(bin_hi, 6) as hi, cast(count as double) as height from h
union all
select curve.event_type, 'curve', grid, round(x, 6), round(x, 6), round(density * scale, 6)
from curve join s on curve.event_type is not distinct from s.event_type"""
SQL["analyze_predictions"] = f"""select location, model_version, target, n, round(rmse, 4) as rmse, round(mae, 4) as mae, round(r2, 4) as r2
from (with {PRED_CTE}, {ALIGNED_CTE} {_metrics_sql('aligned', ['location', 'model_version'])})"""


# ------------------------------------------- trend changes and Fourier seasons
def _fourier() -> str:
    """Sums of products over each history, then elimination row by row in a recursive CTE."""
    import math

    from trendlake.operators import fourier as fo

    def terms(t: str, day: str) -> list[str]:
        out = ["1.0::double", f"({t}) / {fo.YEAR}::double"]
        out += [f"greatest({t} - {j * fo.HINGE_DAYS}, 0.0::double) / {fo.YEAR}::double" for j in range(1, fo.HINGES + 1)]
        for period, order in ((7.0, fo.WEEKLY_ORDER), (fo.YEAR, fo.YEARLY_ORDER)):
            for k in range(1, order + 1):
                out += [f"{f}({day} * {2 * math.pi * k / period!r}::double)" for f in ("sin", "cos")]
        return out

    on = ["true", "true"] + [f"t * {fo.CHANGEPOINT_RANGE} >= {j * fo.HINGE_DAYS}" for j in range(1, fo.HINGES + 1)]
    on += [f"t >= {fo.WEEKLY_FROM}"] * (2 * fo.WEEKLY_ORDER) + [f"t >= {fo.YEARLY_FROM}"] * (2 * fo.YEARLY_ORDER)
    p = len(on)
    ridge = fo.ridges(fo.HINGES, fo.WEEKLY_ORDER, fo.YEARLY_ORDER, fo.HINGE_RIDGE, fo.SEASON_RIDGE)
    frame = "over (partition by location order by date)"
    sums = ", ".join([f"sum(x{i} * x{j}) {frame} as g{i}_{j}" for i in range(p) for j in range(i, p)]
                     + [f"sum(x{i} * y) {frame} as b{i}" for i in range(p)])

    def cell(i: int, j: int) -> str:
        g = f"g{min(i, j)}_{max(i, j)} * m{i} * m{j}"
        return f"{g} + {ridge[i]}::double + 1 - m{i}" if i == j else g

    matrix = ", ".join("[" + ", ".join([cell(i, j) for j in range(p)] + [f"b{i} * m{i}"]) + "]" for i in range(p))
    matrix += ", [" + ", ".join([f"n{i} * m{i}" for i in range(p)] + ["0.0::double"]) + "]"
    return f"""
with recursive {OBS_CTE},
s as (select location, date, coalesce(new_cases, 0)::double as y, date_diff('day', date '1970-01-01', date)::double as day,
             date_diff('day', min(date) over (partition by location), date)::double as t from obs),
x as (select *, {', '.join(f'{c} as x{i}' for i, c in enumerate(terms('t', 'day')))},
             {', '.join(f'{c} as n{i}' for i, c in enumerate(terms('t + 1', '(day + 1)')))},
             {', '.join(f'case when {c} then 1.0::double else 0.0::double end as m{i}' for i, c in enumerate(on))} from s),
g as (select *, {sums} from x),
e(location, date, t, m) as (
  select location, date, t, [{matrix}] from g
  union all
  select location, date, t, list_transform(m[2:], lambda r: list_transform(range(2, len(r) + 1), lambda j: r[j] - r[1] / m[1][1] * m[1][j]))
  from e where len(m) > 1)
select location, date, cast(date + 1 as date) as target_date, '{fo.DEFAULT_VERSION}' as model_version,
       round(case when t > 0 then -m[1][1] end, 4) as new_cases_predicted
from e where len(m) = 1"""


SQL["forecast_fourier"] = _fourier()


# the learners' own errors are beyond SQL; that they are below the running mean's is what is claimed
SQL["regression_beats_mean"] = f"""
with {OBS_CTE}, {POBS_CTE},
mean_of_day as (select i.date, sum(j.total_deaths) / count(*) as mean from (select distinct date from pobs) i join pobs j on j.date <= i.date group by i.date),
judged as (select a.date, b.total_deaths as actual from pobs a join pobs b on a.location = b.location and b.date = cast(a.date + 1 as date)),
v(model_version, since) as (select 'rf_v1', cast(min(date) + 1 as date) from pobs union all select 'rf_daily_v1', cast(min(date) + 1 as date) from pobs
                            union all select 'gbt_v1', date '1997-01-01')
select v.model_version, cast(count(*) as bigint) as n, round(sqrt(avg(power(actual - mean, 2))), 6) as mean_rmse, true as better
from judged join mean_of_day using (date) join v on date >= since
group by v.model_version"""


SQL["stream_compacted"] = SQL["stream_replay"] = SQL["daily_series"]

SQL["publish_report"] = f"""
with {OBS_CTE},
w as (select case day(date) when 1 then 'no location' when 2 then 'no date' when 3 then 'not a finite number' end as reason from obs),
c as (select case when reason is null then 'sent' else 'failed' end as status, reason, cast(count(*) as bigint) as n from w group by reason)
select status, reason, n, cast(sum(n) over (partition by status) as bigint) as observed from c"""


def _metrics_of_scopes() -> str:
    parts = []
    for scope, keys in (("model", ["model_version"]), ("location", ["location", "model_version"]), ("month", ["model_version", "month"])):
        columns = [k if k in keys else f"cast(null as {'date' if k == 'month' else 'varchar'}) as {k}" for k in ("location", "model_version", "month")]
        parts.append(f"select '{scope}' as scope, {', '.join(columns)}, target, n, rmse, mae, r2 from ({_metrics_sql('judged', keys)}) x")
    return (f"with {PRED_CTE}, {ALIGNED_CTE}, judged as (select *, cast(date_trunc('month', date) as date) as month from aligned) "
            + " union all ".join(parts))


SQL["metrics_state"] = _metrics_of_scopes()
