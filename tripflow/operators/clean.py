"""Monthly cleaning of raw trip files into typed, filtered trips.

Rules per service (``ServiceSpec``):

* integer columns are cast with ``try_cast`` (text, doubles and bigints of
  any monthly file become int, junk becomes null);
* the high-volume vendor is the 6th character of the licence (``HV0003`` ->
  3);
* a row is kept when its vendor is in the service's list, its pickup is at
  or after the first second of the folder's month and its drop-off at or
  before the month's last second. Null in any of the three drops the row.
  A trip that crosses the month end therefore leaves the data set: that is
  the rule, not an accident of this implementation;
* double columns are cast, and for the high-volume service the six money
  columns have null and NaN replaced by 0.

``clean_month`` takes the month as literals, which the parquet scan uses to
skip row groups. ``clean_months`` cleans any number of months in one job,
the month coming from ``year``/``month`` columns (partition columns or
values taken from the file path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.casts import int_from_any
from tripflow.functions.timecols import (
    month_bounds,
    month_end_col,
    month_start_col,
    timestamp_literal,
)
from tripflow.schemas import ServiceSpec, service

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _vendor_value(df: DataFrame, spec: ServiceSpec) -> Column:
    if spec.licence_digit:
        return F.substring(F.col(spec.vendor_col), 6, 1).try_cast("int")
    return int_from_any(F.col(spec.vendor_col), df.schema[spec.vendor_col].dataType)


def _vendor_predicate(raw: DataFrame, spec: ServiceSpec) -> Column:
    """Vendor test. On an integral raw column ``isin`` gives the same answer
    before and after the int cast (out-of-range values are never in the
    list), and a predicate on the raw column reaches the parquet reader."""
    dtype = raw.schema[spec.vendor_col].dataType
    if not spec.licence_digit and isinstance(dtype, _INTEGRAL):
        return F.col(spec.vendor_col).isin(spec.vendors)
    return _vendor_value(raw, spec).isin(spec.vendors)


def fill_zero(col: Column) -> Column:
    """Null and NaN -> 0 (what ``fillna(0)`` does to a double column)."""
    return F.when(col.isNull() | F.isnan(col), F.lit(0.0)).otherwise(col)


def _typed_projection(df: DataFrame, spec: ServiceSpec) -> list[Column]:
    """All columns in their order, with the service's casts and fills."""
    ints = set(spec.int_cols)
    doubles = set(spec.double_cols)
    fills = set(spec.fill_cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in df.columns:
        c = F.col(name)
        if name == spec.vendor_col:
            c = _vendor_value(df, spec)
        elif name in ints:
            c = int_from_any(c, types[name])
        elif name in doubles:
            c = c.try_cast("double")
            if name in fills:
                c = fill_zero(c)
        cols.append(c.alias(name))
    return cols


def _clean(df: DataFrame, spec: ServiceSpec, in_month: Column) -> DataFrame:
    return df.filter(_vendor_predicate(df, spec) & in_month).select(*_typed_projection(df, spec))


def clean_month(df: DataFrame, spec: ServiceSpec | str, year: int, month: int) -> DataFrame:
    """Clean one month's raw trips of one service (bounds as literals)."""
    spec = service(spec)
    start, end = month_bounds(year, month)
    schema = df.schema
    pick_t = schema[spec.pickup_col].dataType
    drop_t = schema[spec.dropoff_col].dataType
    in_month = (F.col(spec.pickup_col) >= timestamp_literal(start, pick_t)) & (
        F.col(spec.dropoff_col) <= timestamp_literal(end, drop_t)
    )
    return _clean(df, spec, in_month)


def clean_months(
    df: DataFrame,
    spec: ServiceSpec | str,
    year_col: str = "year",
    month_col: str = "month",
) -> DataFrame:
    """Clean many months at once; each row is judged against its own
    folder month, held in ``year_col``/``month_col``."""
    spec = service(spec)
    schema = df.schema
    ntz_pick = isinstance(schema[spec.pickup_col].dataType, T.TimestampNTZType)
    ntz_drop = isinstance(schema[spec.dropoff_col].dataType, T.TimestampNTZType)
    y = F.col(year_col).try_cast("int")
    m = F.col(month_col).try_cast("int")
    in_month = (F.col(spec.pickup_col) >= month_start_col(y, m, ntz_pick)) & (
        F.col(spec.dropoff_col) <= month_end_col(y, m, ntz_drop)
    )
    return _clean(df, spec, in_month)
