"""Registered queries of answers that are kept up to date (the report by month, cleaned
months, five answers from one read, late rides counted, compacted versions), of a
global ranking, and of records of the other services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import metrics as M
from tripflow.operators.changed import clean_changed, read_cleaned
from tripflow.operators.clean import clean_months
from tripflow.operators.partials import IncrementalReport
from tripflow.operators.ranking import global_rank
from tripflow.operators.report import REPORT_MEASURES
from tripflow.operators.wire import encode_rides
from tripflow.plans.adapters import green_trips_from_events, raw_trips_from_lineitem, rides_from_events
from tripflow.plans.catalog_io import LATE_EVENT_TYPE, SPLIT_DAY
from tripflow.plans.catalog_rides import ride_stream
from tripflow.schemas import GREEN, HIGH_VOLUME, YELLOW
from tripflow.session import scratch_path
from tripflow.sinks.repeatable import publish_once, published
from tripflow.sources.stream import parquet_stream
from tripflow.sources.tables import read_table
from tripflow.streaming.compacted import read_compacted, start_compacted
from tripflow.streaming.fanout import fanout_answers, fanout_status, start_fanout
from tripflow.streaming.runner import finish, query_status

# The month that the incremental report has wrong at first.
CORRECTED = (1996, 2)


def q_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by months: all but one year, that year with one month
    incomplete, then that month alone. Equals the full report."""
    from tripflow.plans.catalog import q_unify_two, rounded_sums

    path = scratch_path(spark, "incremental-trips")
    q_unify_two(spark, sf_dir).write.parquet(path)
    trips = spark.read.parquet(path)
    year, month = F.year("pickup_datetime"), F.month("pickup_datetime")
    found = trips.select("service_type", year.alias("y"), month.alias("m")).distinct().collect()  # one a service and month
    every = [(r["service_type"], r["y"], r["m"]) for r in found]
    report = IncrementalReport(spark, scratch_path(spark, "incremental"), REPORT_MEASURES)
    fixed_year, fixed_month = CORRECTED
    this_year = [x for x in every if x[1] == fixed_year]
    fixed = (year == fixed_year) & (month == fixed_month)
    report.refresh(trips.filter(year != fixed_year), [x for x in every if x[1] != fixed_year])
    report.refresh(trips.filter((year == fixed_year) & (~fixed | (F.col("trip_distance") < 10))), this_year)
    report.refresh(trips.filter(fixed), [x for x in this_year if x[2] == fixed_month])
    return rounded_sums(report.report())


def _one_read(rides: DataFrame, root: str) -> DataFrame:
    """Run the fan-out over what is there; its status as the listener counts it."""
    query = start_fanout(rides, f"{root}/answers", f"{root}/checkpoint", f"fanout_{root[-12:]}", "availableNow")
    finish(query)
    return query_status(rides.sparkSession, [query])


def q_multi_query_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five metrics from one query that reads the source once, then restarted without new data."""
    rides = ride_stream(spark, sf_dir)
    root = scratch_path(spark, "one-read")
    status = _one_read(rides, root)
    _one_read(rides, root)
    answers = fanout_answers(spark, f"{root}/answers", rides.schema)
    trips = {
        "running_totals": F.sum("total_trips"),
        "window_metrics": F.sum("total_trips_last_month"),
        "surcharged_trips": F.sum("trips_with_surcharge_count"),
        "anomalies": F.count(F.lit(1)),
        "peak_windows": F.sum("trip_count"),
    }
    every = None
    for name, answer in answers.items():
        row = answer.agg(F.count(F.lit(1)).cast("int").alias("answer_rows"), trips[name].cast("long").alias("answer_trips"))
        row = row.select(F.lit(name).alias("name"), "answer_rows", "answer_trips")
        every = row if every is None else every.unionByName(row)
    return every.withColumn("input_rows", F.lit(status.first()["input_rows"]).cast("long"))


def q_window_metrics_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window metrics as the one query keeps them: closed windows in the archive, open ones in the state."""
    rides = ride_stream(spark, sf_dir)
    root = scratch_path(spark, "one-read-windows")
    _one_read(rides, root)
    return fanout_answers(spark, f"{root}/answers", rides.schema)["window_metrics"]


def q_late_rows_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries with restarts, the last one late: late rides counted one by one, and the windows without them."""
    events = read_table(spark, sf_dir, "events")
    late = F.col("event_type") == LATE_EVENT_TYPE
    part = F.when(late, 2).when(F.dayofmonth("ts") <= SPLIT_DAY, 0).otherwise(1)
    root = scratch_path(spark, "late-counted")
    events.withColumn("part", part).write.partitionBy("part").parquet(f"{root}/staged")
    for k in range(3):
        spark.read.schema(events.schema).parquet(f"{root}/staged/part={k}").write.mode("append").parquet(f"{root}/events")
        rides = rides_from_events(parquet_stream(spark, f"{root}/events", events.schema))
        _one_read(rides, root)
    status = fanout_status(spark, f"{root}/answers").first()
    return fanout_answers(spark, f"{root}/answers", rides.schema)["window_metrics"].agg(
        F.lit(status["input_rows"]).alias("input_rows"),
        F.lit(status["late_rows"]).alias("late_rows"),
        F.count(F.lit(1)).alias("windows"),
        F.sum("total_trips_last_month").alias("window_trips"),
    )


def q_window_metrics_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window metrics in update mode over three batches, compacted after each second batch, with a restart."""
    rides = ride_stream(spark, sf_dir)
    plan = M.flatten_window(M.window_metrics(rides, exact=True))
    root, keys = scratch_path(spark, "compacted"), ["window_start", "window_end"]
    for _ in range(2):
        query = start_compacted(
            plan, f"{root}/out", keys, every=2, checkpoint=f"{root}/checkpoint", trigger="availableNow",
            state_partitions=M.STATE_PARTITIONS_WINDOWED,
        )
        finish(query, name="compacted")
    return read_compacted(spark, f"{root}/out", plan.schema, keys)


def q_clean_changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green months cleaned with one of them incomplete, again without a change, and again with that month mended."""
    raw = raw_trips_from_lineitem(read_table(spark, sf_dir, "lineitem"), GREEN)
    root, target = scratch_path(spark, "changed-raw"), scratch_path(spark, "changed-clean")
    year, month = CORRECTED
    this = (F.col("year") == year) & (F.col("month") == month)
    parts = ["year", "month"]
    raw.filter(~this | (F.col("trip_distance") < 10)).hint("rebalance", *parts).write.partitionBy(*parts).parquet(f"{root}/green")
    first = clean_changed(spark, root, target, GREEN)
    again = clean_changed(spark, root, target, GREEN)
    # the filter reads every line item: each split by a task of its own, and only the month's trips move
    mended = raw.filter(this).drop(*parts).hint("rebalance")
    mended.write.mode("overwrite").parquet(f"{root}/green/year={year}/month={month}")
    last = clean_changed(spark, root, target, GREEN)
    if again.cleaned or again.removed or last.cleaned != [CORRECTED] or CORRECTED not in first.cleaned:
        raise AssertionError(f"cleaned the wrong months: {again}, {last.cleaned}")
    schema = clean_months(raw, GREEN).schema
    return read_cleaned(spark, target, schema)


def q_peak_zone_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of each pickup zone and half hour, numbered from the busiest on; no task holds them all."""
    rides = rides_from_events(read_table(spark, sf_dir, "events"))
    counted = rides.groupBy("PULocationID", F.window(M.EVENT_TIME, "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("trip_count"))
    flat = M.flatten_window(counted, "w").withColumnsRenamed({"w_start": "window_start", "w_end": "window_end"})
    return global_rank(flat, [F.desc("trip_count"), F.col("window_start"), F.col("PULocationID")], "busiest")


def _encoded(spec):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Cleaned trips of a service, doubles and all, as records."""
        raw = raw_trips_from_lineitem(read_table(spark, sf_dir, "lineitem"), spec)
        return encode_rides(clean_months(raw, spec), spec)

    return run


def q_publish_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides published in part, then whole, then once more: each record once, numbered by pickup within its key."""
    trips = green_trips_from_events(read_table(spark, sf_dir, "events"))
    target = scratch_path(spark, "published-once")
    publish_once(spark, trips.filter(F.dayofmonth(GREEN.pickup_col) <= SPLIT_DAY), GREEN, target, chunk_rows=500)
    sent = publish_once(spark, trips, GREEN, target, chunk_rows=500)
    if not sent or publish_once(spark, trips, GREEN, target, chunk_rows=500):
        raise AssertionError("a repeated publish must send nothing")
    return published(spark, target)


QUERIES = {
    "report_incremental": q_report_incremental,
    "multi_query_one_read": q_multi_query_one_read,
    "window_metrics_one_read": q_window_metrics_one_read,
    "late_rows_counted": q_late_rows_counted,
    "window_metrics_5min_compacted": q_window_metrics_compacted,
    "clean_changed_months": q_clean_changed_months,
    "peak_zone_windows": q_peak_zone_windows,
    "publish_repeated": q_publish_repeated,
    "wire_encode_yellow": _encoded(YELLOW),
    "wire_encode_high_volume": _encoded(HIGH_VOLUME),
}
