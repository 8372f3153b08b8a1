"""Registered queries that write and read back: cleaned months, report and
details write modes, the fixed-schema read, the parquet stream sink with a
restart, several queries over one source, and late data across restarts.

All scratch output goes under the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import metrics as M
from tripflow.operators.report import REPORT_MEASURES, zone_month_report
from tripflow.operators.wire import decode_rides
from tripflow.plans.adapters import green_trips_from_events, raw_trips_from_lineitem, rides_from_events
from tripflow.plans.catalog_rides import DELIVERIES, _ntz, deliver, ride_stream
from tripflow.schemas import GREEN, GREEN_FIXED_SCHEMA
from tripflow.session import scratch_path
from tripflow.sinks.writers import publish_rides, write_clean, write_details, write_report
from tripflow.sources.parquet import read_month, read_months_merged, read_with_schema, read_year
from tripflow.sources.stream import parquet_stream
from tripflow.sources.tables import read_table
from tripflow.streaming.runner import (
    await_all,
    finish,
    query_status,
    read_table_sink,
    run_to_parquet,
    start_query,
)

# Event type held back and delivered late by the late-data query.
LATE_EVENT_TYPE = "view"
# Day of month that splits the on-time events into two deliveries.
SPLIT_DAY = 20
# Year of the queries over month folders.
DRIFT_YEAR = 1996


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def q_clean_write_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean all green months in one job, write ``year=/month=`` partitions
    (dynamic overwrite, twice: the rerun must not duplicate), read every
    year back through the ``year=*/*`` folder glob with a file-name filter."""
    from tripflow.operators.clean import clean_months

    root = scratch_path(spark, "clean")
    cleaned = clean_months(raw_trips_from_lineitem(_table(spark, sf_dir, "lineitem"), GREEN), GREEN)
    out = f"{root}/{GREEN.folder}"
    # line items of all months are mixed in every split: ask for clustering
    write_clean(cleaned, out, partition_cols=["year", "month"], cluster=True)
    write_clean(cleaned, out, partition_cols=["year", "month"], cluster=True)
    return read_year(spark, root, GREEN, "*", glob_filter="*.parquet", partitioned=True)


def q_read_fixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw green files (location ids stored as bigint, payment type as
    text) read with the declared 20-field schema."""
    raw = raw_trips_from_lineitem(_table(spark, sf_dir, "lineitem"), GREEN).drop("year", "month")
    path = scratch_path(spark, "raw-green")
    raw.write.parquet(path)
    out = read_with_schema(spark, path, GREEN_FIXED_SCHEMA)
    return _ntz(out, ("lpep_pickup_datetime", "lpep_dropoff_datetime"))


def q_report_write_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the report (fail-if-exists), check that a second write is
    refused, replace it with overwrite, read it back."""
    from tripflow.plans.catalog import q_unify_two, rounded_sums

    report = zone_month_report(q_unify_two(spark, sf_dir), REPORT_MEASURES)
    target = scratch_path(spark, "report")
    write_report(report, target)
    try:
        write_report(report, target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError("a second fail-if-exists report write must be refused")
    write_report(report, target, mode="overwrite")
    return rounded_sums(spark.read.parquet(target))


def q_details_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details written twice in each mode: append doubles the rows, replace
    keeps one copy. Then one month is replaced by some of its rows, which
    leaves the other months. Counted per service."""
    from tripflow.plans.catalog import q_unify_two

    written = scratch_path(spark, "details-trips")
    q_unify_two(spark, sf_dir).write.parquet(written)
    trips = spark.read.parquet(written)
    targets = {k: scratch_path(spark, f"details-{k}") for k in ("append", "replace", "month_replaced")}
    for _ in range(2):
        write_details(trips, targets["append"], mode="append", cluster=True)
        write_details(trips, targets["replace"], mode="replace", cluster=True)
    write_details(trips, targets["month_replaced"], mode="replace", cluster=True)
    month = trips.filter(F.date_trunc("month", "pickup_datetime") == F.lit("1996-02-01").cast("timestamp"))
    write_details(month.filter("trip_distance >= 10"), targets["month_replaced"], mode="replace", cluster=True)
    every = None
    for kind, path in targets.items():
        rows = spark.read.parquet(path).select("service_type", F.lit(kind).alias("kind"))
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy("service_type").agg(
        *(F.count_if(F.col("kind") == kind).alias(f"rows_{kind}") for kind in targets)
    )


def q_clean_drifting_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year whose month files differ: zones as int, bigint, double or text,
    vendors as bigint or text, and one column in every other month only."""
    from tripflow.operators.clean import clean_months

    root = scratch_path(spark, "drifting")
    raw = raw_trips_from_lineitem(_table(spark, sf_dir, "lineitem"), GREEN).filter(F.col("year") == DRIFT_YEAR)
    staged = f"{root}/staged"
    raw.write.partitionBy("month").parquet(staged)
    for month in range(1, 13):
        one = spark.read.schema(raw.drop("month").schema).parquet(f"{staged}/month={month}").drop("year")
        zone = ("int", "bigint", "double", "string")[month % 4]
        one = one.withColumns({c: F.col(c).cast(zone) for c in ("PULocationID", "DOLocationID")})
        if month % 3 == 0:
            one = one.withColumn("VendorID", F.col("VendorID").cast("string"))
        if month % 2:
            one = one.withColumn("note", F.concat(F.lit("n"), F.col("trip_distance").cast("int").cast("string")))
        one.write.parquet(f"{root}/{GREEN.folder}/{DRIFT_YEAR}/{month:02d}/")
    cleaned = clean_months(read_months_merged(spark, root, GREEN, [DRIFT_YEAR]), GREEN)
    return _ntz(cleaned, ("lpep_pickup_datetime", "lpep_dropoff_datetime"))


def q_read_one_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month's folder written and read by its path."""
    root = scratch_path(spark, "one-month")
    raw = raw_trips_from_lineitem(_table(spark, sf_dir, "lineitem"), GREEN)
    for month in (2, 3):
        one = raw.filter((F.col("year") == DRIFT_YEAR) & (F.col("month") == month)).drop("year", "month")
        write_clean(one, f"{root}/{GREEN.folder}/{DRIFT_YEAR}/{month:02d}/")
    return read_month(spark, root, GREEN, DRIFT_YEAR, 2)


def q_clean_month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month cleaned into four files by the job; files and trips counted."""
    from tripflow.jobs import run_clean

    root, out = scratch_path(spark, "month-raw"), scratch_path(spark, "month-clean")
    raw = raw_trips_from_lineitem(_table(spark, sf_dir, "lineitem"), GREEN)
    one = raw.filter((F.col("year") == DRIFT_YEAR) & (F.col("month") == 2)).drop("year", "month")
    write_clean(one, f"{root}/{GREEN.folder}/{DRIFT_YEAR}/02/")
    for _ in range(2):
        run_clean(spark, root, out, GREEN.name, DRIFT_YEAR, 2)
    cleaned = spark.read.parquet(f"{out}/{GREEN.folder}")
    return cleaned.agg(
        F.count_distinct("_metadata.file_path").cast("int").alias("files"),
        F.count(F.lit(1)).alias("trips"),
        F.sum("PULocationID").cast("long").alias("zones"),
    )


def q_publish_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides published as records to a folder, read back, the value taken as bytes and decoded."""
    target = scratch_path(spark, "published")
    publish_rides(green_trips_from_events(_table(spark, sf_dir, "events")), GREEN, target, fmt="parquet")
    records = spark.read.parquet(target).select(F.col("value").cast("binary").alias("value"))
    return _ntz(decode_rides(records))


def q_stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies streamed into Spark's parquet sink with a checkpoint; the
    query is run a second time on the same checkpoint and adds nothing."""
    rides = ride_stream(spark, sf_dir, keep=["event_id"])
    path, ckpt = run_to_parquet(_ntz(M.anomalies(rides)), "anomalies")
    run_to_parquet(_ntz(M.anomalies(rides)), "anomalies", path=path, checkpoint=ckpt)
    return spark.read.parquet(path)


def _five(rides: DataFrame) -> dict[str, tuple[DataFrame, str, int | None, list[str] | None, Column | None]]:
    """Plan, mode, state partitions, keys and trips of the five metrics."""
    glob, windowed = M.STATE_PARTITIONS_GLOBAL, M.STATE_PARTITIONS_WINDOWED
    keys = ["window_start", "window_end"]
    return {
        "running_totals": (M.running_totals(rides), "update", glob, [], F.sum("total_trips")),
        "window_metrics": (
            M.flatten_window(M.window_metrics(rides)),
            "update",
            windowed,
            keys,
            F.sum("total_trips_last_month"),
        ),
        "surcharged_trips": (M.surcharged_trips(rides), "complete", glob, None, F.sum("trips_with_surcharge_count")),
        "anomalies": (M.anomalies(rides), "append", None, None, F.count(F.lit(1))),
        "peak_windows": (
            M.flatten_window(M.peak_windows(rides), "pickup_window"),
            "complete",
            windowed,
            None,
            F.sum("trip_count"),
        ),
    }


def _start_five(rides: DataFrame, root: str) -> dict:
    return {
        name: start_query(
            plan,
            name=f"{name}_{root[-12:]}",
            mode=mode,
            sink="table",
            path=f"{root}/out/{name}",
            checkpoint=f"{root}/checkpoint/{name}",
            trigger="availableNow",
            state_partitions=parts,
        )
        for name, (plan, mode, parts, _, _) in _five(rides).items()
    }


def _answers(spark: SparkSession, rides: DataFrame, root: str) -> DataFrame:
    """Rows and trips of each metric's answer."""
    every = None
    for name, (plan, mode, _, keys, trips) in _five(rides).items():
        answer = read_table_sink(spark, f"{root}/out/{name}", mode, keys, schema=plan.schema)
        row = answer.agg(F.count(F.lit(1)).cast("int").alias("answer_rows"), trips.cast("long").alias("answer_trips"))
        row = row.select(F.lit(name).alias("name"), "answer_rows", "answer_trips")
        every = row if every is None else every.unionByName(row)
    return every


def q_multi_query_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five metrics started together over one source, then waited for;
    returns each query's name, activity, input rows and answer."""
    rides = ride_stream(spark, sf_dir)
    root = scratch_path(spark, "multi")
    started = _start_five(rides, root)
    await_all(started)
    status = query_status(spark, started)
    short = F.regexp_replace(F.col("name"), "_[0-9a-f]{12}$", "")
    return status.select(short.alias("name"), "is_active", "input_rows").join(_answers(spark, rides, root), "name")


def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five metrics over deliveries with a restart after each: every
    start resumes from the checkpoints and the answers are those of one run."""
    events = _table(spark, sf_dir, "events")
    root = scratch_path(spark, "restart")
    for k in range(len(DELIVERIES)):
        deliver(events, f"{root}/events", k)
        rides = rides_from_events(parquet_stream(spark, f"{root}/events", events.schema, max_files_per_trigger=1))
        await_all(_start_five(rides, root))
    await_all(_start_five(rides, root))  # nothing new
    return _answers(spark, rides, root)


def q_late_data_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window metrics over three deliveries of the events: on-time rows up
    to day 20, on-time rows after it, then every ``view`` event late. Each
    delivery is a restart of the same query from its checkpoint; late rows
    whose window ended before the previous watermark are dropped."""
    events = _table(spark, sf_dir, "events")
    late = F.col("event_type") == LATE_EVENT_TYPE
    part = F.when(late, 2).when(F.dayofmonth("ts") <= SPLIT_DAY, 0).otherwise(1)
    staged, stage, out, ckpt = (scratch_path(spark, n) for n in ("late-parts", "late-stage", "late-out", "late-ckpt"))
    events.withColumn("part", part).write.partitionBy("part").parquet(staged)  # the events are read once
    for i in range(3):
        spark.read.schema(events.schema).parquet(f"{staged}/part={i}").write.mode("append").parquet(stage)
        rides = rides_from_events(parquet_stream(spark, stage, events.schema))
        plan = M.flatten_window(M.window_metrics(rides, exact=True))
        q = start_query(
            plan,
            mode="update",
            sink="table",
            path=out,
            checkpoint=ckpt,
            trigger="availableNow",
            state_partitions=M.STATE_PARTITIONS_WINDOWED,
        )
        finish(q, name=f"late-data delivery {i}")
    return read_table_sink(spark, out, "update", ["window_start", "window_end"], schema=plan.schema)


QUERIES = {
    "clean_write_readback": q_clean_write_readback,
    "read_fixed_schema": q_read_fixed_schema,
    "report_write_modes": q_report_write_modes,
    "details_append": q_details_append,
    "stream_parquet_sink": q_stream_parquet_sink,
    "multi_query_status": q_multi_query_status,
    "late_data_drop": q_late_data_drop,
    "stream_restart": q_stream_restart,
    "clean_drifting_months": q_clean_drifting_months,
    "read_one_month": q_read_one_month,
    "clean_month_files": q_clean_month_files,
    "publish_readback": q_publish_readback,
}
