"""Time helpers: month bounds (as literals or as columns), trip duration."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def month_bounds(year: int, month: int) -> tuple[datetime, datetime]:
    """First second of a month, and the second before the next month starts."""
    start = datetime(year, month, 1)
    following = start.replace(year=year + month // 12, month=month % 12 + 1)
    return start, following - timedelta(seconds=1)


def timestamp_literal(value: datetime, dtype: T.DataType | None = None) -> Column:
    """A timestamp literal in the column's own type.

    Built from text, so the Python process's local time zone never enters;
    constant folding turns it into a plain literal and parquet push-down
    keeps working.
    """
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    target = dtype if dtype is not None else T.TimestampNTZType()
    return F.lit(text).cast(target)


def month_start_col(year: Column | str, month: Column | str, ntz: bool = True) -> Column:
    """First instant of the month given by two integer columns."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    z = F.lit(0)
    if ntz:
        return F.make_timestamp_ntz(y, m, F.lit(1), z, z, z)
    return F.make_timestamp(y, m, F.lit(1), z, z, z)


def month_end_col(year: Column | str, month: Column | str, ntz: bool = True) -> Column:
    """Last second of the month given by two integer columns."""
    start = month_start_col(year, month, ntz)
    return start + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 SECOND")


def trip_seconds(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> Column:
    """Whole seconds between two instants, truncating each first."""
    return F.unix_timestamp(F.col(dropoff)) - F.unix_timestamp(F.col(pickup))
