"""tripflow: trip-record cleaning, reporting, wire encoding and streaming
metrics as Spark DataFrame jobs.

The names below are the public API; modules hold the rest.
"""

from tripflow.operators.clean import clean_month, clean_months
from tripflow.operators.metrics import (
    anomalies,
    peak_windows,
    recent_rides,
    running_totals,
    surcharged_trips,
    window_metrics,
)
from tripflow.operators.report import zone_month_report, zone_month_report_sql
from tripflow.operators.unify import to_common, unify, union_services
from tripflow.operators.wire import decode_full_rides, decode_rides, encode_rides
from tripflow.schemas import GREEN, HIGH_VOLUME, YELLOW, service
from tripflow.session import get_session
from tripflow.sinks.writers import publish_rides, write_clean, write_details, write_report
from tripflow.sources.parquet import read_month, read_months, read_months_merged, read_year
from tripflow.sources.stream import KafkaSource, ride_stream
from tripflow.streaming.runner import read_table_sink, run_to_table, start_query

__version__ = "0.1.0"

__all__ = [
    "GREEN",
    "HIGH_VOLUME",
    "YELLOW",
    "KafkaSource",
    "anomalies",
    "clean_month",
    "clean_months",
    "decode_full_rides",
    "decode_rides",
    "encode_rides",
    "get_session",
    "peak_windows",
    "publish_rides",
    "read_month",
    "read_months",
    "read_months_merged",
    "read_table_sink",
    "read_year",
    "recent_rides",
    "ride_stream",
    "run_to_table",
    "running_totals",
    "service",
    "start_query",
    "surcharged_trips",
    "to_common",
    "unify",
    "union_services",
    "window_metrics",
    "write_clean",
    "write_details",
    "write_report",
    "zone_month_report",
    "zone_month_report_sql",
]
