"""Backtest jobs: observations → prediction table.

The reference loops over locations and days on the driver, refitting two
models per row and inserting one row per commit. Here:

* the windowed forecast (W2) scores every (location, origin) for all three
  targets in one pass (one shuffle by location);
* the tree regressions (R1/R2) are refit at cutoffs and score every origin
  (see ``operators.regress``);
* all model outputs are stacked with ``unionByName`` and written once.

The prediction table keeps the reference's row form — day d's actuals beside
the forecast for d + 1 — plus ``target_date`` and ``model_cutoff``; evaluation
re-aligns by ``target_date`` (``operators.evaluate.align_to_target``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.operators import forecast as fc
from trendlake.operators.prep import fill_nulls, filter_locations
from trendlake.schema import PREDICTIONS, REFERENCE_MODEL_VERSION

ACTUALS = {"new_cases": "new_cases_actual", "new_deaths": "new_deaths_actual",
           "new_vaccinations": "new_vaccinations_actual"}
CARRIED = ["total_cases", "total_deaths", "life_expectancy", "excess_mortality"]


def to_prediction_schema(df: DataFrame) -> DataFrame:
    """Project onto the PREDICTIONS columns, adding missing ones as typed nulls."""
    cols = []
    for f in PREDICTIONS.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def prepped(obs: DataFrame, locations=None) -> DataFrame:
    """Location filter + numeric null fill, as the reference prepares its training frame."""
    return fill_nulls(filter_locations(obs, locations))


def forecast_predictions(obs: DataFrame, locations=None, model_version: str = fc.DEFAULT_VERSION,
                         targets: tuple[str, ...] = ("new_cases", "new_deaths", "new_vaccinations"),
                         missing: str = "null", reference_mode: bool = False,
                         seasonality: tuple[str, ...] = ("weekly",)) -> DataFrame:
    """Windowed forecasts of every target for every (location, origin day).

    ``reference_mode=True`` reproduces the reference's stored row: only cases
    are forecast, vaccinations are the constant 0 (Q16) and failures are 0 (P13).
    """
    d = prepped(obs, locations)
    if reference_mode:
        targets, missing = ("new_cases",), "zero"
    f = fc.forecast_frame(d, list(targets), seasonality=seasonality)
    preds = {}
    for tg in ("new_cases", "new_deaths", "new_vaccinations"):
        if tg in targets:
            p = F.col(f"yhat_{tg}")
            if missing == "zero":
                p = F.coalesce(F.nanvl(p, F.lit(0.0)), F.lit(0.0))
            preds[f"{tg}_predicted"] = p
        elif reference_mode and tg == "new_vaccinations":
            preds[f"{tg}_predicted"] = F.lit(0.0)
    out = f.withColumns(preds).withColumns({a: F.col(t) for t, a in ACTUALS.items()})
    out = (out.withColumn("model_version", F.lit(model_version))
              .withColumn("target_date", F.date_add("date", 1)))
    return to_prediction_schema(out)


def backtest(obs: DataFrame, locations=None, models: tuple[str, ...] = ("trend_dow",),
             combine: bool = False, regress_kwargs: dict | None = None,
             model_dir: str | None = None, seasonality: tuple[str, ...] = ("weekly",)) -> DataFrame:
    """Stacked predictions of the requested models (one row per location, origin, version).

    ``models``: ``"trend_dow"`` (windowed W2 forecast of all targets), ``"rf"`` and
    ``"gbt"`` (MLlib regressions of new_deaths at refit cutoffs).
    ``combine=True`` joins W2 cases with the first regression's deaths into the
    reference's single ``combined_model_v1`` row per input row; the regression then
    pairs, zero-fills and (for a list of locations) trains per location as the
    reference does, unless ``regress_kwargs`` say otherwise.
    ``model_dir`` saves the fitted models: the windowed model's state table under
    ``trend_dow/`` and each regression's MLlib models (S11).
    """
    from trendlake.operators import regress as rg

    parts: list[DataFrame] = []
    for m in models:
        if m == "trend_dow":
            parts.append(forecast_predictions(obs, locations, seasonality=seasonality))
            if model_dir:
                from trendlake.sinks.tables import write_coefficients
                state = fc.model_state(prepped(obs, locations), ["new_cases", "new_deaths", "new_vaccinations"],
                                       seasonality=seasonality)
                write_coefficients(state, f"{model_dir.rstrip('/')}/trend_dow")
        elif m in rg.MODELS:
            kw = dict(regress_kwargs or {})
            if combine:  # the reference's pairing, its zeros, and its models per listed location
                kw = {"mode": "next_day", "missing": "zero"} | kw
                if isinstance(locations, (list, tuple)):
                    kw.setdefault("per_location", list(locations))
            if model_dir:
                kw.setdefault("model_dir", model_dir)
            r = rg.rolling_regression(prepped(obs, locations), model=m, **kw)
            parts.append(to_prediction_schema(r))
        else:
            raise ValueError(f"unknown model {m!r}")
    if combine:
        w2 = forecast_predictions(obs, locations, reference_mode=True, seasonality=seasonality)
        reg = [p for m, p in zip(models, parts) if m != "trend_dow"]
        if not reg:
            raise ValueError("combine=True needs a regression model")
        # one row per day on the right: replayed days don't multiply the rows
        deaths = reg[0].groupBy(F.col("location").alias("_loc"), F.col("date").alias("_day")).agg(
            F.min("new_deaths_predicted").alias("_deaths"), F.max("model_cutoff").alias("_cutoff"))
        comb = (w2.join(deaths, w2["location"].eqNullSafe(F.col("_loc")) & (w2["date"] == F.col("_day")), "left")
                  .withColumns({"new_deaths_predicted": F.col("_deaths"), "model_cutoff": F.col("_cutoff"),
                                "model_version": F.lit(REFERENCE_MODEL_VERSION)}))
        return to_prediction_schema(comb)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
