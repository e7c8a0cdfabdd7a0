"""Null- and zero-safe expressions.

Spark 4 runs with ANSI mode on: division by zero and ``corr`` over a
zero-variance group raise instead of returning null. These helpers keep the
reference's "null / NaN, keep going" behaviour while staying JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / den`` with null for a zero or null denominator."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def nan_to_null(x) -> Column:
    """NaN → null (pandas treats both as missing; Spark's ``avg`` would spread NaN)."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def null_safe_corr(x, y) -> Column:
    """Pearson correlation over complete pairs; null when either side is constant.

    ``regr_*`` aggregates skip pairs with a null on either side, exactly like
    pandas' pairwise-complete ``corr``.
    """
    x, y = _c(x), _c(y)
    return safe_div(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def r2_expr(actual, predicted) -> Column:
    """Coefficient of determination 1 − SSE/SST over complete pairs (not ``regr_r2``)."""
    a, p = _c(actual), _c(predicted)
    sse = F.sum(F.pow(a - p, 2))  # null when either side is null → skipped
    return F.lit(1.0) - safe_div(sse, F.regr_syy(a, p))


def label(name_col) -> Column:
    """Column label: underscores → spaces, title case."""
    return F.initcap(F.translate(_c(name_col), "_", " "))
