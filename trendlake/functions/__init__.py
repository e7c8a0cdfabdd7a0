"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from trendlake.functions.exprs import (  # noqa: F401
    label,
    nan_to_null,
    null_safe_corr,
    r2_expr,
    safe_div,
)
