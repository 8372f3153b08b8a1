"""Ride metrics that work on tables and on streams alike.

Each builder takes a DataFrame of typed rides (see ``decode_rides``) and
returns a DataFrame; given a streaming frame the result is a streaming
query plan (start it with ``tripflow.streaming``), given a table it is a
batch plan. ``withWatermark`` is a no-op on tables.

Output names are kept from the original consumer, including the
misleading ``total_trips_last_month``, which counts trips of one 5-minute
window.

State: the global aggregates (running totals, surcharged trips) keep one
row of state; windowed aggregates keep one row per open window, evicted
once the watermark passes the window end (update/append). Complete mode
keeps every window for the life of the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.money import measure_avg, measure_sum
from tripflow.functions.timecols import trip_seconds

EVENT_TIME = "pickup_datetime"

# State store partitions for streaming runs. Every metric pre-aggregates
# before its state store, so the shuffle into the state carries one row
# per task and key, and the state holds one row (global metrics) or one
# row per open window: a handful of partitions serves any input rate.
STATE_PARTITIONS_GLOBAL = 1
STATE_PARTITIONS_WINDOWED = 4

# Thresholds and labels of the anomaly rule.
ANOMALY_FARE = 1000
ANOMALY_DISTANCE = 1000
LABEL_HIGH_AMOUNT = "High amount"
LABEL_LONG_TRIP = "Long trip"
LABEL_NONE = "No anomaly"


def running_totals(rides: DataFrame, exact: bool = False) -> DataFrame:
    """Trips and fare revenue over everything seen (one row)."""
    return rides.agg(
        F.count(F.lit(1)).alias("total_trips"),
        measure_sum("fare_amount", exact).alias("total_revenue"),
    )


def window_metrics(
    rides: DataFrame,
    window: str = "5 minutes",
    watermark: str = "5 minutes",
    exact: bool = False,
) -> DataFrame:
    """Per tumbling pickup window: trips, fare sum and mean, mean tip,
    mean distance, mean duration in whole seconds."""
    duration = trip_seconds(EVENT_TIME, "dropoff_datetime")
    return (
        rides.withWatermark(EVENT_TIME, watermark)
        .groupBy(F.window(EVENT_TIME, window))
        .agg(
            F.count(F.lit(1)).alias("total_trips_last_month"),
            measure_sum("fare_amount", exact).alias("total_revenue_last5mins"),
            measure_avg("fare_amount", exact).alias("avg_revenue_last_5mins"),
            measure_avg("tip_amount", exact).alias("avg_tip"),
            measure_avg("trip_distance", exact).alias("avg_trip_distance_last_5mins"),
            F.avg(duration).alias("avg_trip_duration_seconds_last_5mins"),
        )
    )


def anomaly_label(
    fare_threshold: float = ANOMALY_FARE, distance_threshold: float = ANOMALY_DISTANCE
) -> Column:
    """Fare is tested first, then distance."""
    return (
        F.when(F.col("fare_amount") > fare_threshold, F.lit(LABEL_HIGH_AMOUNT))
        .when(F.col("trip_distance") > distance_threshold, F.lit(LABEL_LONG_TRIP))
        .otherwise(F.lit(LABEL_NONE))
    )


def anomalies(
    rides: DataFrame,
    fare_threshold: float = ANOMALY_FARE,
    distance_threshold: float = ANOMALY_DISTANCE,
    only_anomalies: bool = True,
) -> DataFrame:
    """Rides with an ``Anomaly`` label (stateless, so append mode streams it).

    With ``only_anomalies`` (the original behaviour) rows over neither
    threshold are filtered out and ``No anomaly`` never appears.
    """
    out = rides
    if only_anomalies:
        out = out.filter(
            (F.col("trip_distance") > distance_threshold) | (F.col("fare_amount") > fare_threshold)
        )
    return out.withColumn("Anomaly", anomaly_label(fare_threshold, distance_threshold))


def surcharged_trips(rides: DataFrame, watermark: str = "5 minutes") -> DataFrame:
    """Count of rides with a positive congestion surcharge (one row)."""
    return (
        rides.withWatermark(EVENT_TIME, watermark)
        .filter(F.col("congestion_surcharge") > 0)
        .agg(F.count(F.lit(1)).alias("trips_with_surcharge_count"))
    )


def peak_windows(
    rides: DataFrame,
    window: str = "30 minutes",
    watermark: str = "30 minutes",
    sort: bool = True,
) -> DataFrame:
    """Trips per tumbling pickup window, busiest first.

    Sorting a stream is only allowed in complete mode; ties are ordered by
    window start so that the order is stable.
    """
    out = (
        rides.withWatermark(EVENT_TIME, watermark)
        .groupBy(F.window(EVENT_TIME, window).alias("pickup_window"))
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )
    if sort:
        out = out.orderBy(F.desc("trip_count"), F.col("pickup_window.start"))
    return out


def recent_rides(rides: DataFrame, span: str = "5 minutes", now: Column | None = None) -> DataFrame:
    """Rides picked up within ``span`` of ``now`` (default: current time)."""
    reference = now if now is not None else F.current_timestamp()
    return rides.filter(F.col(EVENT_TIME) >= reference - F.expr(f"INTERVAL {span}"))


def flatten_window(df: DataFrame, col: str = "window", ntz: bool = True) -> DataFrame:
    """Replace a window struct by ``{col}_start``/``{col}_end`` columns."""
    start, end = F.col(f"{col}.start"), F.col(f"{col}.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    others = [c for c in df.columns if c != col]
    return df.select(start.alias(f"{col}_start"), end.alias(f"{col}_end"), *others)
