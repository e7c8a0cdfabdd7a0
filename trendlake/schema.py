"""Fixed schemas and column lists."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results:
# the 12 observation fields in message order, the prediction table's columns,
# the regression features and target, and the dashboard's metric lists.
# ---------------------------------------------------------------------------
OBS_FIELDS = [
    ("location", T.StringType()),
    ("date", T.StringType()),
    ("total_cases", T.DoubleType()),
    ("new_cases", T.DoubleType()),
    ("total_deaths", T.DoubleType()),
    ("new_deaths", T.DoubleType()),
    ("total_vaccinations", T.DoubleType()),
    ("people_vaccinated", T.DoubleType()),
    ("people_fully_vaccinated", T.DoubleType()),
    ("new_vaccinations", T.DoubleType()),
    ("life_expectancy", T.DoubleType()),
    ("excess_mortality", T.DoubleType()),
]
REGRESSION_FEATURES = ["total_cases", "new_cases", "total_deaths", "life_expectancy",
                       "excess_mortality", "new_vaccinations"]
REGRESSION_TARGET = "new_deaths"
FORECAST_TARGET = "new_cases"
CORR_COLUMNS = ["new_cases_actual", "new_deaths_actual", "total_cases", "total_deaths",
                "life_expectancy", "excess_mortality", "new_vaccinations_actual"]
COMPARE_METRICS = ["new_cases_actual", "new_deaths_actual", "total_cases", "total_deaths",
                   "life_expectancy", "excess_mortality"]
CHART_KINDS = ["scatter", "line", "bar", "histogram", "box", "area", "violin"]
ANALYSIS_KINDS = ["predictions", "data_analysis", "interactive", "error_analysis",
                  "summary_statistics"]
REFERENCE_MODEL_VERSION = "combined_model_v1"
# ---------------------------------------------------------------------------

# Wire schema of a message: ``date`` arrives as a string.
OBS_WIRE = T.StructType([T.StructField(n, t, True) for n, t in OBS_FIELDS])
# Same, plus the permissive parser's corrupt-record column.
OBS_WIRE_CORRUPT = T.StructType(OBS_WIRE.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
# Stored observation: ``date`` is a DateType (day grain everywhere downstream).
OBS = T.StructType([T.StructField(n, T.DateType() if n == "date" else t, True) for n, t in OBS_FIELDS])
OBS_NUMERIC = [n for n, t in OBS_FIELDS if isinstance(t, T.DoubleType)]

PREDICTIONS = T.StructType([
    T.StructField("location", T.StringType(), True),
    T.StructField("date", T.DateType(), True),  # forecast origin
    T.StructField("new_cases_predicted", T.DoubleType(), True),
    T.StructField("new_deaths_predicted", T.DoubleType(), True),
    T.StructField("new_vaccinations_predicted", T.DoubleType(), True),
    T.StructField("new_cases_actual", T.DoubleType(), True),
    T.StructField("new_deaths_actual", T.DoubleType(), True),
    T.StructField("new_vaccinations_actual", T.DoubleType(), True),
    T.StructField("total_cases", T.DoubleType(), True),
    T.StructField("total_deaths", T.DoubleType(), True),
    T.StructField("life_expectancy", T.DoubleType(), True),
    T.StructField("excess_mortality", T.DoubleType(), True),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("created_at", T.DateType(), True),
    # additions: the forecast's target day and the regression's training cutoff
    T.StructField("target_date", T.DateType(), True),
    T.StructField("model_cutoff", T.DateType(), True),
])
PREDICTION_COLUMNS = [f.name for f in PREDICTIONS.fields]
# JDBC DDL so string keys are VARCHAR, not CLOB (pushed-down '=' needs it).
PREDICTIONS_JDBC_TYPES = "location VARCHAR(255), model_version VARCHAR(255)"
