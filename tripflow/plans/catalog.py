"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their
oracle SQL. Every query reads the driver's tables (through the adapters)
in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.clean import clean_month, clean_months
from tripflow.operators.report import (
    REPORT_CORE_MEASURES,
    REPORT_MEASURES,
    zone_month_report,
    zone_month_report_sql,
)
from tripflow.operators.unify import to_common, union_services
from tripflow.plans import oracle_sql as O
from tripflow.plans.adapters import raw_trips_from_lineitem
from tripflow.schemas import GREEN, HIGH_VOLUME, TRIP_COLUMNS, TRIP_CORE_COLUMNS, YELLOW
from tripflow.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

# The short month of the single-month cleaning queries (29 days).
CLEAN_YEAR, CLEAN_MONTH = 1996, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def raw_trips(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    return raw_trips_from_lineitem(table(spark, sf_dir, "lineitem"), spec)


def _one_folder(raw: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one folder month (what reading that month's folder gives)."""
    return raw.filter((F.col("year") == year) & (F.col("month") == month)).drop("year", "month")


def _clean_month_query(spec) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _one_folder(raw_trips(spark, sf_dir, spec), CLEAN_YEAR, CLEAN_MONTH)
        return clean_month(raw, spec, CLEAN_YEAR, CLEAN_MONTH)

    return run


def cleaned_all_months(spark: SparkSession, sf_dir: str, spec, keep_folder: bool = False) -> DataFrame:
    out = clean_months(raw_trips(spark, sf_dir, spec), spec)
    return out if keep_folder else out.drop("year", "month")


def unified(spark: SparkSession, sf_dir: str, specs, columns) -> DataFrame:
    return union_services(
        [to_common(cleaned_all_months(spark, sf_dir, s), s, columns) for s in specs]
    )


def q_clean_all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept per service and folder month, bounds taken from columns."""
    frames = []
    for spec in (GREEN, YELLOW, HIGH_VOLUME):
        cleaned = cleaned_all_months(spark, sf_dir, spec, keep_folder=True)
        frames.append(
            cleaned.select(
                F.lit(spec.name).alias("service_type"),
                "year",
                "month",
                F.col(spec.pickup_col).alias("pickup"),
            )
        )
    rows = union_services(frames)
    return rows.groupBy("service_type", "year", "month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("pickup").alias("first_pickup"),
        F.max("pickup").alias("last_pickup"),
    )


def q_unify_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified(spark, sf_dir, (GREEN, YELLOW), TRIP_COLUMNS)


def q_unify_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified(spark, sf_dir, (GREEN, YELLOW, HIGH_VOLUME), TRIP_CORE_COLUMNS)


def q_hv_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified(spark, sf_dir, (HIGH_VOLUME,), TRIP_CORE_COLUMNS)


def rounded_sums(report: DataFrame) -> DataFrame:
    """Money sums to cents: plain double sums differ in their last digits with the order of rows."""
    return report.withColumns({c: F.round(c, 2) for c in report.columns if c.startswith("revenue_monthly_")})


def q_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_sums(zone_month_report(q_unify_two(spark, sf_dir), REPORT_MEASURES))


def q_report_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_sums(zone_month_report(q_unify_three(spark, sf_dir), REPORT_CORE_MEASURES))


def q_report_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_sums(zone_month_report_sql(spark, q_unify_two(spark, sf_dir), "trips_data", REPORT_MEASURES))


def _queries() -> dict[str, QueryFn]:
    return {
        "clean_green_month": _clean_month_query(GREEN),
        "clean_yellow_month": _clean_month_query(YELLOW),
        "clean_hv_month": _clean_month_query(HIGH_VOLUME),
        "clean_all_months": q_clean_all_months,
        "hv_total_amount": q_hv_total,
        "unify_two_services": q_unify_two,
        "unify_three_services": q_unify_three,
        "zone_month_report": q_report,
        "zone_month_report_core": q_report_core,
        "zone_month_report_sql": q_report_sql,
    }


def _clean_all_months_sql() -> str:
    parts = []
    for s in ("green", "yellow", "high volume"):
        pick = {"green": "lpep_pickup_datetime", "yellow": "tpep_pickup_datetime"}.get(
            s, "pickup_datetime"
        )
        parts.append(
            f"SELECT '{s}' AS service_type, year, month, {pick} AS pickup "
            f"FROM ({O.clean_sql(s, None, keep_folder=True)}) AS c{len(parts)}"
        )
    union = " UNION ALL ".join(parts)
    return (
        "SELECT service_type, year, month, COUNT(*) AS trips, "
        "min(pickup) AS first_pickup, max(pickup) AS last_pickup "
        f"FROM ({union}) AS u GROUP BY 1, 2, 3"
    )


def _oracle() -> dict[str, str]:
    month = f"{CLEAN_YEAR}-{CLEAN_MONTH:02d}"
    return {
        "clean_green_month": O.clean_sql("green", month, keep_folder=False),
        "clean_yellow_month": O.clean_sql("yellow", month, keep_folder=False),
        "clean_hv_month": O.clean_sql("high volume", month, keep_folder=False),
        "clean_all_months": _clean_all_months_sql(),
        "hv_total_amount": O.unified_sql(["high volume"], core=True),
        "unify_two_services": O.unified_sql(["green", "yellow"], core=False),
        "unify_three_services": O.unified_sql(["green", "yellow", "high volume"], core=True),
        "zone_month_report": O.report_sql(["green", "yellow"], core=False),
        "zone_month_report_core": O.report_sql(["green", "yellow", "high volume"], core=True),
        "zone_month_report_sql": O.report_sql(["green", "yellow"], core=False),
    }


def queries() -> dict[str, QueryFn]:
    from tripflow.plans import catalog_io, catalog_kept, catalog_rides

    out = _queries()
    out.update(catalog_rides.QUERIES)
    out.update(catalog_io.QUERIES)
    out.update(catalog_kept.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = _oracle()
    out.update(
        {
            "wire_encode": O.WIRE_ENCODE_SQL,
            "wire_decode": O.WIRE_DECODE_SQL,
            "wire_roundtrip": O.WIRE_ROUNDTRIP_SQL,
            "wire_decode_full": O.WIRE_DECODE_FULL_SQL,
            "running_totals": O.RUNNING_TOTALS_SQL,
            "running_totals_stream": O.RUNNING_TOTALS_SQL,
            "window_metrics_5min": O.window_metrics_sql(),
            "window_metrics_5min_update": O.window_metrics_sql(),
            "window_metrics_5min_complete": O.window_metrics_sql(),
            "window_metrics_5min_append": O.window_metrics_sql(append=True),
            "anomalies": O.ANOMALIES_SQL,
            "anomalies_stream": O.ANOMALIES_SQL,
            "surcharged_trips": O.SURCHARGED_SQL,
            "surcharged_trips_stream": O.SURCHARGED_SQL,
            "peak_windows_30min": O.PEAK_WINDOWS_SQL,
            "peak_windows_30min_stream": O.PEAK_WINDOWS_SQL,
            "recent_rides": O.recent_rides_sql("6 hours"),
            "clean_write_readback": O.READBACK_SQL,
            "read_fixed_schema": O.FIXED_SCHEMA_SQL,
            "report_write_modes": O.report_sql(["green", "yellow"], core=False),
            "details_append": O.DETAILS_SQL,
            "stream_parquet_sink": O.ANOMALIES_SQL,
            "multi_query_status": O.MULTI_STATUS_SQL,
            "late_data_drop": O.late_data_sql(),
            "stream_restart": O.ANSWERS_SQL,
            "clean_drifting_months": O.DRIFTING_SQL.replace("c.*", "c.* EXCLUDE (l_quantity)"),
            "read_one_month": O.ONE_MONTH_SQL,
            "clean_month_files": O.MONTH_FILES_SQL,
            "report_incremental": O.report_sql(["green", "yellow"], core=False),
            "multi_query_one_read": O.ONE_READ_SQL,
            "window_metrics_one_read": O.window_metrics_sql(),
            "late_rows_counted": O.late_rows_sql(),
            "window_metrics_5min_compacted": O.window_metrics_sql(),
            "clean_changed_months": O.READBACK_SQL,
            "peak_zone_windows": O.PEAK_ZONE_WINDOWS_SQL,
            "publish_repeated": O.PUBLISH_REPEATED_SQL,
            "wire_encode_yellow": O.wire_encode_sql("yellow"),
            "wire_encode_high_volume": O.wire_encode_sql("high volume"),
            "publish_readback": O.WIRE_DECODE_SQL.replace("SELECT event_id, ", "SELECT "),
        }
    )
    return out
