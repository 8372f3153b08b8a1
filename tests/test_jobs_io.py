from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripflow.jobs import load_cleaned, run_clean, run_report
from tripflow.operators.clean import clean_months
from tripflow.operators.wire import decode_rides
from tripflow.plans.adapters import green_trips_from_events, raw_trips_from_lineitem
from tripflow.schemas import GREEN, YELLOW
from tripflow.session import scratch_path
from tripflow.sinks.writers import publish_rides, write_clean
from tripflow.sources.parquet import read_month, read_months, read_year
from tripflow.sources.stream import text_stream
from tripflow.streaming.runner import run_to_table

YEAR = 1996


def _raw_folders(spark, sf_small, spec, root):
    """Raw trips written in the original ``{service}/{year}/{MM}/`` layout."""
    raw = raw_trips_from_lineitem(spark.read.parquet(f"{sf_small}/lineitem.parquet"), spec)
    raw = raw.filter(F.col("year") == YEAR).cache()
    for m in range(1, 13):
        write_clean(raw.filter(F.col("month") == m).drop("year", "month"), f"{root}/{spec.folder}/{YEAR}/{m:02d}/", files=2)
    return raw


def test_folder_layout_cleaned_in_one_job(spark, sf_small):
    root = scratch_path(spark, "raw")
    raw = _raw_folders(spark, sf_small, GREEN, root)
    assert read_month(spark, root, GREEN, YEAR, 3).count() == raw.filter("month = 3").count()
    assert read_year(spark, root, GREEN, YEAR).count() == raw.count()
    months = read_months(spark, root, GREEN, [YEAR])
    assert months.select("year", "month").distinct().count() == 12
    expected = clean_months(raw, GREEN).count()
    assert clean_months(months, GREEN).count() == expected

    out = scratch_path(spark, "clean-out")
    run_clean(spark, root, out, "green", YEAR, None)
    run_clean(spark, root, out, "green", YEAR, None)  # rerun: no duplicates
    assert load_cleaned(spark, out, "green", YEAR).count() == expected
    one = scratch_path(spark, "clean-one")
    run_clean(spark, root, one, "green", YEAR, 3)
    got = spark.read.parquet(f"{one}/green").filter("month = 3")
    assert got.count() == clean_months(raw.filter("month = 3"), GREEN).count()
    raw.unpersist()


def test_report_job_over_two_services(spark, sf_small):
    root = scratch_path(spark, "raw2")
    out = scratch_path(spark, "clean2")
    for spec in (GREEN, YELLOW):
        _raw_folders(spark, sf_small, spec, root).unpersist()
        run_clean(spark, root, out, spec.name, YEAR, None)
    rep, det = scratch_path(spark, "rep"), scratch_path(spark, "det")
    run_report(spark, out, YEAR, ["green", "yellow"], rep, det, replace=True)
    run_report(spark, out, YEAR, ["green", "yellow"], rep, det, replace=True)
    report = spark.read.parquet(rep)
    details = spark.read.parquet(det)
    assert set(r.service_type for r in report.select("service_type").distinct().collect()) == {"green", "yellow"}
    a = report.agg(F.sum("revenue_monthly_fare")).first()[0]
    b = details.agg(F.sum("fare_amount")).first()[0]
    assert abs(a - b) < 1e-6 * max(1.0, abs(b))


def test_publish_then_consume_as_stream(spark, sf_small):
    trips = green_trips_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    target = scratch_path(spark, "topic")
    encoded_path = scratch_path(spark, "encoded")
    from tripflow.operators.wire import encode_rides

    encode_rides(trips, GREEN).select("value").write.text(encoded_path)
    publish_rides(trips, GREEN, target)  # json records with key and value
    assert spark.read.json(target).count() == trips.count()
    rides = decode_rides(text_stream(spark, encoded_path))
    got = run_to_table(rides, "append", "consume")
    assert got.count() == trips.count()
    assert got.filter(F.col("congestion_surcharge").isNotNull()).count() == trips.filter(
        F.col("congestion_surcharge").isNotNull()
    ).count()


def test_command_line_jobs(spark, sf_small):
    from tripflow.jobs import main

    partitions = spark.conf.get("spark.sql.shuffle.partitions")

    root, out = scratch_path(spark, "cli-raw"), scratch_path(spark, "cli-clean")
    raw = _raw_folders(spark, sf_small, GREEN, root)
    main(["clean", "--root", root, "--out", out, "--service", "green", "--year", str(YEAR)])
    one = scratch_path(spark, "cli-month")
    main(["clean", "--root", root, "--out", one, "--service", "green", "--year", str(YEAR), "--month", "5"])
    assert len(spark.read.parquet(f"{one}/green/year={YEAR}/month=5").inputFiles()) == 4
    main(["clean", "--root", root, "--out", out, "--service", "green", "--year", str(YEAR), "--month", "5", "--files", "2"])
    rep = scratch_path(spark, "cli-report")
    main(["report", "--root", out, "--year", str(YEAR), "--services", "green", "--report-out", rep])
    assert spark.read.parquet(rep).agg(F.sum("revenue_monthly_fare")).first()[0] is not None
    # the jobs reuse the running session without resizing it
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    raw.unpersist()


def test_consume_job_refuses_half_a_target():
    from tripflow.jobs import main, parser

    base = ["consume", "--bootstrap", "b:1", "--topic", "t"]
    for bad in (["--out", "x"], ["--checkpoint", "x"], ["--sink", "table"], ["--sink", "console", "--out", "x", "--checkpoint", "y"]):
        with pytest.raises(SystemExit):
            main([*base, *bad])
    with pytest.raises(SystemExit):
        main([*base, "--sink", "parquet"])
    args = parser().parse_args([*base, "--security", "SASL_SSL", "--max-offsets", "5", "--kafka-option", "a=b"])
    from tripflow.jobs import _source

    src = _source(args)
    assert (src.security, src.max_offsets_per_trigger, src.extra) == ("SASL_SSL", 5, {"a": "b"})


def test_consume_resumes_after_restart_and_lost_commit(spark, sf_small):
    """Two starts with more files in between, and a replay of a batch whose commit was lost."""
    from tripflow.jobs import ride_queries, start_consume
    from tripflow.operators.wire import encode_rides
    from tripflow.streaming.runner import await_all, query_status, read_table_sink

    trips = green_trips_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    lines, out, ckpt = (scratch_path(spark, n) for n in ("re-lines", "re-out", "re-ckpt"))
    days = [(1, 8), (9, 14), (15, 31)]

    def deliver(lo, hi):
        part = trips.filter(F.dayofmonth("lpep_pickup_datetime").between(lo, hi))
        encode_rides(part, GREEN).select("value").coalesce(2).write.mode("append").text(lines)
        return part.count()

    def run():
        started = start_consume(spark, lines, out, ckpt, trigger="availableNow", max_per_trigger=1, exact=True)
        await_all(started)
        return {r.name: r.input_rows for r in query_status(spark, started).collect()}

    n = deliver(*days[0])
    assert set(run().values()) == {n}
    n = deliver(*days[1])
    assert set(run().values()) == {n}
    for name in ("running_totals", "window_metrics", "surcharged_trips", "anomalies", "peak_windows"):
        commits = Path(ckpt.removeprefix("file:")) / name / "commits"
        last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        last.unlink()
        (commits / f".{last.name}.crc").unlink(missing_ok=True)
    deliver(*days[2])
    run()
    rides = decode_rides(encode_rides(trips, GREEN))
    for name, (plan, mode, _, keys) in ride_queries(rides, exact=True).items():
        got = read_table_sink(spark, f"{out}/{name}", mode, keys).collect()
        assert sorted(map(str, got)) == sorted(map(str, plan.collect())), name
    # another query must not write into these folders
    other = start_consume(spark, lines, out, scratch_path(spark, "other"), trigger="availableNow")
    for q in other.values():
        with pytest.raises(Exception, match="another query"):
            await_all([q])
    spark.streams.resetTerminated()
    with pytest.raises(ValueError, match="checkpoint"):
        start_consume(spark, lines, out)


def test_consume_queries_with_table_sinks(spark, sf_small):
    from tripflow.jobs import ride_queries
    from tripflow.operators import metrics as M
    from tripflow.operators.wire import encode_rides
    from tripflow.streaming.runner import await_all, read_table_sink, start_query

    trips = green_trips_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    lines = scratch_path(spark, "lines")
    for day in range(1, 31, 10):  # three deliveries -> three micro-batches at least
        part = trips.filter(F.dayofmonth("lpep_pickup_datetime").between(day, day + 9))
        encode_rides(part, GREEN).select("value").write.mode("append").text(lines)
    rides = decode_rides(text_stream(spark, lines, max_files_per_trigger=1))
    started, paths = {}, {}
    for name, (plan, mode, parts, keys) in ride_queries(rides, exact=True).items():
        paths[name] = (scratch_path(spark, f"consume-{name}"), mode, keys)
        started[name] = start_query(
            plan, mode=mode, sink="table", path=paths[name][0], trigger="availableNow",
            state_partitions=parts,
        )
    await_all(started, timeout=300)
    batch_rides = decode_rides(encode_rides(trips, GREEN))
    want = sorted(map(tuple, M.window_metrics(batch_rides, exact=True).collect()))
    path, mode, keys = paths["window_metrics"]
    got = sorted(map(tuple, read_table_sink(spark, path, mode, keys).collect()))
    assert got == want
    totals = read_table_sink(spark, *paths["running_totals"]).first()
    assert totals.total_trips == trips.count()
