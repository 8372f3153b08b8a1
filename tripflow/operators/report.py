"""Monthly revenue per pickup zone and service.

One hash aggregation on (zone, month, service): each task pre-aggregates its
rows (partial aggregate), so the shuffle carries one row per group per task
whatever the skew of a zone; the final aggregate then merges those. The
number of groups is zones x months x services, a few hundred thousand at
most, so the output is small at any input size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.money import EXACT_TYPE, measure_avg, measure_sum


@dataclass(frozen=True)
class Measure:
    kind: str  # "sum" or "avg"
    column: str
    alias: str


# Measure names of the two report shapes, in output order.
REPORT_MEASURES = [
    Measure("sum", "fare_amount", "revenue_monthly_fare"),
    Measure("sum", "extra", "revenue_monthly_extra"),
    Measure("sum", "mta_tax", "revenue_monthly_mta_tax"),
    Measure("sum", "tip_amount", "revenue_monthly_tip_amount"),
    Measure("sum", "tolls_amount", "revenue_monthly_tolls_amount"),
    Measure("sum", "improvement_surcharge", "revenue_monthly_improvement_surcharge"),
    Measure("sum", "total_amount", "revenue_monthly_total_amount"),
    Measure("sum", "congestion_surcharge", "revenue_monthly_congestion_surcharge"),
    Measure("avg", "passenger_count", "avg_monthly_passenger_count"),
    Measure("avg", "trip_distance", "avg_monthly_trip_distance"),
]

REPORT_CORE_MEASURES = [
    Measure("sum", "fare_amount", "revenue_monthly_fare"),
    Measure("sum", "mta_tax", "revenue_monthly_mta_tax"),
    Measure("sum", "tip_amount", "revenue_monthly_tip_amount"),
    Measure("sum", "tolls_amount", "revenue_monthly_tolls_amount"),
    Measure("sum", "total_amount", "revenue_monthly_total_amount"),
    Measure("sum", "congestion_surcharge", "revenue_monthly_congestion_surcharge"),
    Measure("avg", "trip_distance", "avg_monthly_trip_distance"),
]


def _month_col(trips: DataFrame, ts: str) -> Column:
    truncated = F.date_trunc("month", F.col(ts))
    # date_trunc returns timestamp; keep the input's own time type
    if isinstance(trips.schema[ts].dataType, T.TimestampNTZType):
        truncated = truncated.cast("timestamp_ntz")
    return truncated


def measures_for(trips: DataFrame) -> list[Measure]:
    """Full measures when the trips carry all of them, else the core ones."""
    have = set(trips.columns)
    if all(m.column in have for m in REPORT_MEASURES):
        return REPORT_MEASURES
    return REPORT_CORE_MEASURES


def zone_month_report(
    trips: DataFrame,
    measures: list[Measure] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Sums and averages per (``revenue_zone``, ``revenue_month``, ``service_type``).

    The default is the plain double ``sum``/``avg``; ``exact=True`` gives
    figures that don't depend on partitioning or row order (see
    ``functions.money``).
    """
    measures = measures or measures_for(trips)
    aggs = []
    for m in measures:
        fn = measure_sum if m.kind == "sum" else measure_avg
        aggs.append(fn(m.column, exact).alias(m.alias))
    return trips.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        _month_col(trips, "pickup_datetime").alias("revenue_month"),
        F.col("service_type"),
    ).agg(*aggs)


def report_sql(view: str, measures: list[Measure], exact: bool = False, ntz: bool = True) -> str:
    """The same report as Spark SQL text over a registered view."""
    lines = []
    for m in measures:
        if exact:
            c = m.column
            value = f"TRY_CAST({c} AS {EXACT_TYPE})"
            expr = (
                f"CASE WHEN COUNT_IF({c} IS NOT NULL AND {value} IS NULL) > 0 "
                f"THEN SUM(CAST({c} AS DOUBLE)) ELSE CAST(SUM({value}) AS DOUBLE) END"
            )
            if m.kind == "avg":
                expr = f"({expr}) / COUNT({c})"
        else:
            expr = f"{m.kind.upper()}({m.column})"
        lines.append(f"    {expr} AS {m.alias}")
    month = "date_trunc('month', pickup_datetime)"
    if ntz:
        month = f"CAST({month} AS TIMESTAMP_NTZ)"
    body = ",\n".join(lines)
    return (
        "SELECT\n"
        "    PULocationID AS revenue_zone,\n"
        f"    {month} AS revenue_month,\n"
        "    service_type,\n"
        f"{body}\n"
        f"FROM {view}\n"
        "GROUP BY 1, 2, 3"
    )


def zone_month_report_sql(
    spark: SparkSession,
    trips: DataFrame,
    view: str = "trips_data",
    measures: list[Measure] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Register ``trips`` as ``view`` and run the report as SQL text."""
    measures = measures or measures_for(trips)
    trips.createOrReplaceTempView(view)
    ntz = isinstance(trips.schema["pickup_datetime"].dataType, T.TimestampNTZType)
    return spark.sql(report_sql(view, measures, exact, ntz))
