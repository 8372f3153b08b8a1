"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from tripflow.functions.casts import conform, int_from_any
from tripflow.functions.money import exact_avg, exact_sum
from tripflow.functions.timecols import (
    month_bounds,
    month_end_col,
    month_start_col,
    timestamp_literal,
    trip_seconds,
)

__all__ = [
    "conform",
    "exact_avg",
    "exact_sum",
    "int_from_any",
    "month_bounds",
    "month_end_col",
    "month_start_col",
    "timestamp_literal",
    "trip_seconds",
]
