"""Sums and averages of measures: plain by default, exact on demand.

A ``sum`` over doubles depends in its last digits on the order rows arrive
in. The exact form adds decimals instead (each value to ``SCALE`` decimals),
so two runs over differently partitioned input agree to the bit; it costs a
decimal sum and two counters more for each measure. A group that holds a value
which no ``decimal(28, 6)`` can hold (NaN, an infinity, 10^22 or more) gets
the plain sum, so NaN propagates. Both forms return doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6
EXACT_TYPE = f"decimal(28,{SCALE})"


def exact_sum(col: str) -> Column:
    """Order-independent ``sum``, as double."""
    exact = F.col(col).try_cast(EXACT_TYPE)
    unsafe = F.count_if(F.col(col).isNotNull() & exact.isNull())
    plain = F.sum(F.col(col).cast("double"))
    return F.when(unsafe > 0, plain).otherwise(F.sum(exact).cast("double"))


def exact_avg(col: str) -> Column:
    """``exact_sum`` over the number of values."""
    return exact_sum(col) / F.count(col)


def measure_sum(col: str, exact: bool) -> Column:
    return exact_sum(col) if exact else F.sum(col).cast("double")


def measure_avg(col: str, exact: bool) -> Column:
    return exact_avg(col) if exact else F.avg(col).cast("double")
