import pytest
import time
from datetime import datetime

from pyspark.sql import functions as F

from tripflow.operators import metrics as M
from tripflow.session import scratch_path
from tripflow.sources.stream import KafkaSource, kafka_options, parquet_stream
from tripflow.streaming.runner import query_status, read_table_sink, run_to_table, start_query

RIDE_SCHEMA = (
    "VendorID string, pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int, "
    "trip_distance float, fare_amount float, mta_tax float, tip_amount float, tolls_amount float, congestion_surcharge float"
)


def ride(ts, fare=10.0, dist=1.0, cs=None, dur=60):
    p = datetime.fromisoformat(ts)
    d = datetime.fromtimestamp(p.timestamp() + dur)
    return ("1", p, d, 1, 2, dist, fare, 0.5, 1.0, 0.0, cs)


def test_anomaly_rules(spark):
    rows = [
        ride("2024-01-01 00:00:00", fare=1000.0, dist=1.0),  # not over
        ride("2024-01-01 00:00:01", fare=1000.01, dist=1.0),  # high amount
        ride("2024-01-01 00:00:02", fare=2000.0, dist=2000.0),  # fare label wins
        ride("2024-01-01 00:00:03", fare=None, dist=1500.0),  # long trip
        ride("2024-01-01 00:00:04", fare=None, dist=None),  # neither
    ]
    df = spark.createDataFrame(rows, RIDE_SCHEMA)
    got = [(r.fare_amount, r.Anomaly) for r in M.anomalies(df).orderBy("pickup_datetime").collect()]
    assert [a for _, a in got] == ["High amount", "High amount", "Long trip"]
    labels = [r.Anomaly for r in M.anomalies(df, only_anomalies=False).orderBy("pickup_datetime").collect()]
    assert labels == ["No anomaly", "High amount", "High amount", "Long trip", "No anomaly"]


def test_surcharge_count_and_empty_input(spark):
    rows = [ride("2024-01-01 00:00:00", cs=c) for c in (2.75, 0.0, -1.0, None, 0.5)]
    df = spark.createDataFrame(rows, RIDE_SCHEMA)
    assert M.surcharged_trips(df).first().trips_with_surcharge_count == 2
    none = M.surcharged_trips(df.filter(F.lit(False))).collect()
    assert len(none) == 1 and none[0].trips_with_surcharge_count == 0


def test_window_metrics_and_duration(spark):
    rows = [
        ride("2024-01-01 00:01:00", fare=10.0, dur=90),
        ride("2024-01-01 00:04:59", fare=20.0, dur=30),
        ride("2024-01-01 00:05:00", fare=5.0, dur=61),
    ]
    out = M.flatten_window(M.window_metrics(spark.createDataFrame(rows, RIDE_SCHEMA))).orderBy("window_start").collect()
    assert [r.total_trips_last_month for r in out] == [2, 1]
    assert out[0].window_start == datetime(2024, 1, 1, 0, 0) and out[0].window_end == datetime(2024, 1, 1, 0, 5)
    assert out[0].total_revenue_last5mins == 30.0 and out[0].avg_revenue_last_5mins == 15.0
    assert out[0].avg_trip_duration_seconds_last_5mins == 60.0


def test_peak_windows_order_with_ties(spark):
    rows = [ride("2024-01-01 01:10:00"), ride("2024-01-01 00:10:00"), ride("2024-01-01 02:10:00"), ride("2024-01-01 02:20:00")]
    out = M.flatten_window(M.peak_windows(spark.createDataFrame(rows, RIDE_SCHEMA)), "pickup_window").collect()
    assert [r.trip_count for r in out] == [2, 1, 1]
    assert out[1].pickup_window_start < out[2].pickup_window_start  # ties by start


def test_recent_rides_with_injected_now(spark):
    rows = [ride("2024-01-01 00:00:00"), ride("2024-01-01 00:56:00"), ride("2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, RIDE_SCHEMA)
    now = F.lit("2024-01-01 01:00:00").cast("timestamp")
    assert M.recent_rides(df, "5 minutes", now=now).count() == 2


def _write_one(spark, path, ts):
    spark.createDataFrame([ride(ts)], RIDE_SCHEMA).write.mode("append").parquet(path)
    time.sleep(1.1)  # distinct modification times keep the delivery order


def test_late_row_dropped_in_update_kept_in_complete(spark):
    from pyspark.sql.types import StructType

    schema = spark.createDataFrame([], RIDE_SCHEMA).schema
    assert isinstance(schema, StructType)
    results = {}
    for mode in ("update", "complete"):
        src = scratch_path(spark, f"late-{mode}")
        out = scratch_path(spark, f"late-out-{mode}")
        ckpt = scratch_path(spark, f"late-ckpt-{mode}")
        for i, ts in enumerate(["2024-01-01 00:00:00", "2024-01-01 02:00:00", "2024-01-01 02:01:00", "2024-01-01 00:01:00"]):
            _write_one(spark, src, ts)
            plan = M.flatten_window(M.window_metrics(parquet_stream(spark, src, schema)))
            q = start_query(plan, mode=mode, sink="table", path=out, checkpoint=ckpt, trigger="availableNow")
            finished = q.awaitTermination(120)
            if not finished:
                q.stop()
            assert finished and q.exception() is None
        res = read_table_sink(spark, out, mode, ["window_start", "window_end"], schema=plan.schema)
        results[mode] = {r.window_start: r.total_trips_last_month for r in res.collect()}
    assert results["update"][datetime(2024, 1, 1, 0, 0)] == 1
    assert results["complete"][datetime(2024, 1, 1, 0, 0)] == 2


def test_stream_equals_batch(spark, sf_small):
    from tripflow.plans.adapters import rides_from_events
    from tripflow.sources.stream import table_stream

    batch = M.flatten_window(M.window_metrics(rides_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))))
    stream = M.flatten_window(M.window_metrics(rides_from_events(table_stream(spark, sf_small, "events"))))
    got = run_to_table(stream, "update", "eq", keys=["window_start", "window_end"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_empty_stream_gives_empty_answer(spark, sf_small):
    from tripflow.plans.adapters import rides_from_events
    from tripflow.sources.stream import table_stream

    rides = rides_from_events(table_stream(spark, sf_small, "events")).filter(F.lit(False))
    got = run_to_table(M.anomalies(rides), "append", "empty")
    assert got.count() == 0 and "Anomaly" in got.columns


def test_update_sink_keeps_last_version_per_key(spark):
    path = scratch_path(spark, "sink")
    df = spark.createDataFrame([("a", 1, 0), ("b", 5, 0), ("a", 3, 1), ("a", 2, 2)], "k string, v int, batch_id long")
    df.write.partitionBy("batch_id").parquet(path)
    got = {r.k: r.v for r in read_table_sink(spark, path, "update", ["k"]).collect()}
    assert got == {"a": 2, "b": 5}
    assert sorted(r.v for r in read_table_sink(spark, path, "complete").collect()) == [2]
    assert read_table_sink(spark, path, "append").count() == 4


def test_status_and_memory_sink(spark):
    df = spark.readStream.format("rate").option("rowsPerSecond", 10).load()
    q = start_query(df.select("value"), name="rate_probe", mode="append", sink="memory")
    try:
        q.processAllAvailable()
        st = {r.name: r for r in query_status(spark).collect()}
        assert st["rate_probe"].is_active
    finally:
        q.stop()


def test_kafka_options():
    opts = kafka_options(
        KafkaSource("broker:9092", "rides", security="SASL_SSL", mechanism="OAUTHBEARER", token_endpoint="https://t", extra={"x": "1"})
    )
    assert opts["subscribe"] == "rides" and opts["startingOffsets"] == "earliest"
    assert opts["kafka.security.protocol"] == "SASL_SSL" and opts["kafka.sasl.mechanism"] == "OAUTHBEARER"
    assert opts["kafka.sasl.oauthbearer.token.endpoint.url"] == "https://t" and opts["kafka.x"] == "1"


def test_console_sink_await_any_and_ride_stream(spark, sf_small):
    from tripflow.operators.wire import decode_rides, encode_rides
    from tripflow.plans.adapters import green_trips_from_events
    from tripflow.schemas import GREEN
    from tripflow.sources.stream import ride_stream
    from tripflow.streaming.runner import await_any

    path = scratch_path(spark, "wire-lines")
    trips = green_trips_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    encode_rides(trips, GREEN).select("value").write.text(path)
    rides = decode_rides(ride_stream(spark, path))
    q = start_query(M.running_totals(rides), name="console_totals", mode="update", sink="console", trigger="availableNow")
    await_any(spark, 120)
    q.awaitTermination(120)
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == trips.count()


def test_recent_rides_default_now_is_current_time(spark):
    now = datetime.now()
    rows = [ride(now.replace(microsecond=0).isoformat(sep=" ")), ride("2000-01-01 00:00:00")]
    df = spark.createDataFrame(rows, RIDE_SCHEMA)
    assert M.recent_rides(df, "1 hour").count() == 1


def _many_files(spark, sf_small, n):
    """The events table cut into ``n`` files by day (one micro-batch each)."""
    path = scratch_path(spark, "days")
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    for d in range(1, n + 1):
        lo, hi = (d - 1) * 31 // n + 1, d * 31 // n
        ev.filter(F.dayofmonth("ts").between(lo, hi)).write.mode("append").parquet(path)
        time.sleep(1.1)
    return path, ev.schema


def test_table_sink_over_many_batches(spark, sf_small):
    """Every mode gives the batch answer over five batches; complete mode keeps two folders."""
    from tripflow.plans.adapters import rides_from_events

    src, schema = _many_files(spark, sf_small, 5)
    batch = M.flatten_window(M.window_metrics(rides_from_events(spark.read.parquet(src))))
    want = sorted(map(tuple, batch.collect()))
    for mode, keys in (("update", ["window_start", "window_end"]), ("complete", None)):
        out = scratch_path(spark, f"many-{mode}")
        plan = M.flatten_window(M.window_metrics(rides_from_events(parquet_stream(spark, src, schema, max_files_per_trigger=1))))
        q = start_query(plan, mode=mode, sink="table", path=out, trigger="availableNow", state_partitions=2)
        q.awaitTermination()
        assert q.exception() is None
        got = sorted(map(tuple, read_table_sink(spark, out, mode, keys).collect()))
        assert got == want
        if mode == "complete":
            assert spark.read.parquet(out).select("batch_slot").distinct().count() == 2


def test_status_counts_beyond_the_progress_buffer(spark, sf_small):
    from tripflow.plans.adapters import rides_from_events

    src, schema = _many_files(spark, sf_small, 5)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        plan = M.anomalies(rides_from_events(parquet_stream(spark, src, schema, max_files_per_trigger=1)))
        q = start_query(plan, name="many", mode="append", sink="table", path=scratch_path(spark, "many"), trigger="availableNow")
        q.awaitTermination()
        status = query_status(spark, [q]).first()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert status.input_rows == spark.read.parquet(src).count() and status.batches >= 5


def test_a_limit_that_passes_raises(spark):
    from tripflow.streaming.runner import await_all, await_any

    spark.streams.resetTerminated()
    df = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    q = start_query(df.select("value"), name="endless", mode="append", sink="memory")
    try:
        with pytest.raises(TimeoutError):
            await_all([q], timeout=1)
        with pytest.raises(TimeoutError):
            await_any(spark, timeout=1)
    finally:
        q.stop()


def test_stream_global_count_emits_zero_when_all_rows_filtered(spark, sf_small):
    from tripflow.plans.adapters import rides_from_events
    from tripflow.sources.stream import table_stream

    rides = rides_from_events(table_stream(spark, sf_small, "events")).withColumn(
        "congestion_surcharge", F.lit(None).cast("double")
    )
    got = run_to_table(M.surcharged_trips(rides), "complete", "zero", state_partitions=1).collect()
    assert [r.trips_with_surcharge_count for r in got] == [0]
