"""Bring cleaned trips of each service to one schema and union them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schemas import (
    HIGH_VOLUME_PAYMENT_TYPE,
    HIGH_VOLUME_TOTAL_ADDENDS,
    TRIP_COLUMNS,
    TRIP_CORE_COLUMNS,
    ServiceSpec,
    service,
)

_INT_COLUMNS = {"VendorID", "PULocationID", "DOLocationID"}
_TIME_COLUMNS = {"pickup_datetime", "dropoff_datetime"}


def to_common(
    df: DataFrame,
    spec: ServiceSpec | str,
    columns: list[str] | None = None,
) -> DataFrame:
    """Cleaned trips of one service as the unified schema plus ``service_type``,
    in one projection.

    ``payment_type`` is text in every service (the high-volume feed has a
    text constant, the others an integer code), so the union never has to
    reconcile an int with a string.
    """
    spec = service(spec)
    if columns is None:
        columns = TRIP_CORE_COLUMNS if spec.licence_digit else TRIP_COLUMNS
    source = {new: old for old, new in spec.renames.items() if old in df.columns}
    derived: dict[str, object] = {}
    if spec.licence_digit:
        derived["payment_type"] = F.lit(HIGH_VOLUME_PAYMENT_TYPE)
        addends = [F.col(source.get(c, c)) for c in HIGH_VOLUME_TOTAL_ADDENDS]
        derived["total_amount"] = reduce(lambda a, b: a + b, addends)
    cols = []
    for c in columns:
        expr = derived.get(c, F.col(source.get(c, c)))
        if c == "payment_type":
            expr = expr.cast("string")
        elif c in _INT_COLUMNS:
            expr = expr.try_cast("int")
        elif c not in _TIME_COLUMNS:
            expr = expr.try_cast("double")
        cols.append(expr.alias(c))
    return df.select(*cols, F.lit(spec.name).alias("service_type"))


def union_services(frames: list[DataFrame]) -> DataFrame:
    """Bag union of per-service frames by column name (no shuffle)."""
    if not frames:
        raise ValueError("union_services needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)


def unify(
    cleaned: dict[str, DataFrame],
    columns: list[str] | None = None,
) -> DataFrame:
    """``{service name: cleaned frame}`` -> one unified frame.

    With the high-volume service present the core columns are used (it has
    no passenger count, extra or improvement surcharge).
    """
    specs = {name: service(name) for name in cleaned}
    if columns is None:
        has_hv = any(s.licence_digit for s in specs.values())
        columns = TRIP_CORE_COLUMNS if has_hv else TRIP_COLUMNS
    return union_services([to_common(df, specs[n], columns) for n, df in cleaned.items()])


def register_trips(spark: SparkSession, trips: DataFrame, name: str = "trips_data") -> str:
    """Expose the unified trips to SQL as a temporary view."""
    trips.createOrReplaceTempView(name)
    return name
