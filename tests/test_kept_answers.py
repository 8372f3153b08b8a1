"""Five answers from one read, and update-mode answers in few files."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow.operators import metrics as M
from tripflow.plans.adapters import rides_from_events
from tripflow.plans.catalog_rides import DELIVERIES, deliver
from tripflow.sources.stream import parquet_stream
from tripflow.sources.tables import read_table
from tripflow.streaming import compacted, fanout
from tripflow.streaming.runner import finish, query_status, start_query

RIDE = (
    "VendorID string, pickup_datetime timestamp, dropoff_datetime timestamp, PULocationID int, DOLocationID int, "
    "trip_distance double, fare_amount double, mta_tax double, tip_amount double, tolls_amount double, congestion_surcharge double"
)
T0 = datetime(2024, 5, 1, 10, 0, 0)


def ride(minute, fare=10.0, tip=1.0, distance=2.0, surcharge=None, seconds=60):
    at = None if minute is None else T0 + timedelta(minutes=minute)
    return ("1", at, None if at is None else at + timedelta(seconds=seconds), 1, 2, distance, fare, 0.0, tip, 0.0, surcharge)


def answers(spark, path):
    out = {}
    for name, df in fanout.fanout_answers(spark, path, spark.createDataFrame([], RIDE).schema).items():
        out[name] = sorted((tuple(r) for r in df.collect()), key=str)
    return out


def test_fanout_equals_the_metrics(spark, sf_small, tmp_path):
    events = read_table(spark, sf_small, "events")
    root = str(tmp_path)
    for k in range(len(DELIVERIES)):
        deliver(events, f"{root}/events", k)
        rides = rides_from_events(parquet_stream(spark, f"{root}/events", events.schema, max_files_per_trigger=1))
        query = fanout.start_fanout(rides, f"{root}/out", f"{root}/ckpt", f"fan{k}", "availableNow")
        finish(query)
    table = rides_from_events(events)
    got = fanout.fanout_answers(spark, f"{root}/out", rides.schema)
    want = {
        "running_totals": M.running_totals(table, exact=True),
        "window_metrics": M.flatten_window(M.window_metrics(table, exact=True)),
        "surcharged_trips": M.surcharged_trips(table),
        "peak_windows": M.flatten_window(M.peak_windows(table, sort=False), "pickup_window"),
        "anomalies": M.anomalies(table),
    }
    for name, df in want.items():
        assert set(got[name].columns) == set(df.columns)
        assert df.select(*got[name].columns).exceptAll(got[name]).count() == 0, name
        assert got[name].count() == df.count()
    status = fanout.fanout_status(spark, f"{root}/out").first()
    assert (status.input_rows, status.late_rows) == (events.count(), 0)
    # the windows behind the watermark have left the state
    state = spark.read.parquet(f"{root}/out/state").filter("metric = 'window_metrics'")
    last = state.agg(F.max("batch_id")).first()[0]
    assert state.filter(F.col("batch_id") == last).count() <= 3
    with pytest.raises(Exception, match="another query"):
        finish(fanout.start_fanout(rides, f"{root}/out", f"{root}/other", trigger="availableNow"))


def run_batches(spark, path, batches, checkpoint=None):
    write = fanout._batch_writer(path, checkpoint or f"{path}.ckpt", timedelta(minutes=5))
    for k, rows in batches:
        write(spark.createDataFrame(rows, RIDE), k)


@pytest.fixture
def unclaimed(monkeypatch):
    monkeypatch.setattr(fanout, "_claim", lambda *_: None)


BATCHES = [
    [ride(1), ride(2, 20.0), ride(7, surcharge=2.5), ride(None, 5.0)],
    [ride(3, 1500.0), ride(30, None, None, None), ride(31, distance=2000.0, surcharge=1.0)],
    [ride(4), ride(24), ride(26), ride(33, float("nan"))],  # windows that end at 5 and 25 are too late
    [],
    [ride(100)],
]


def test_fanout_late_rides_odd_values_and_empty_batches(spark, tmp_path, unclaimed):
    path = str(tmp_path / "out")
    run_batches(spark, path, enumerate(BATCHES))
    got = answers(spark, path)
    status = fanout.fanout_status(spark, path).first()
    assert (status.batches, status.input_rows, status.late_rows) == (5, 12, 2)
    windows = {r[0]: (r[2], str(r[3])) for r in got["window_metrics"]}
    at = {m: T0 + timedelta(minutes=m) for m in (0, 5, 25, 30, 100)}
    assert windows == {
        at[0]: (3, "1530.0"), at[5]: (1, "10.0"), at[25]: (1, "10.0"), at[30]: (3, "nan"), at[100]: (1, "10.0"),
    }
    assert [r[2] for r in got["peak_windows"]] == [7, 3, 1]  # no ride is too late for the ranking
    assert got["surcharged_trips"] == [(2,)] and len(got["anomalies"]) == 3  # nan is more than any fare
    assert str(got["running_totals"][0]) == "(12, nan)"


@pytest.mark.parametrize("step", ["closed", "anomalies", "state"])
def test_fanout_replays_a_batch_that_died(spark, tmp_path, unclaimed, monkeypatch, step):
    path, want = str(tmp_path / "out"), str(tmp_path / "want")
    run_batches(spark, want, enumerate(BATCHES))
    from pyspark.sql.readwriter import DataFrameWriter

    plain = DataFrameWriter.parquet
    for k, rows in enumerate(BATCHES):

        def dies(self, at, *args, **kwargs):
            if f"/{step}/" in at:
                raise OSError("lost")
            return plain(self, at, *args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(DataFrameWriter, "parquet", dies)
            with pytest.raises(OSError, match="lost"):
                run_batches(spark, path, [(k, rows)])
        run_batches(spark, path, [(k, rows)])
        run_batches(spark, path, [(k, rows)])  # and once more after its state was written
    assert str(answers(spark, path)) == str(answers(spark, want))
    with pytest.raises(RuntimeError, match="no state"):
        run_batches(spark, path, [(9, BATCHES[0])])


def test_late_rows_in_the_status(spark, tmp_path):
    root = str(tmp_path)
    for k, rows in enumerate(BATCHES[:3]):
        spark.createDataFrame(rows, RIDE).coalesce(1).write.mode("append").parquet(f"{root}/rides")
        rides = parquet_stream(spark, f"{root}/rides", spark.createDataFrame([], RIDE).schema)
        query = start_query(
            M.flatten_window(M.window_metrics(rides)), name=f"late{k}", sink="table", path=f"{root}/out",
            checkpoint=f"{root}/ckpt", trigger="availableNow", state_partitions=1,
        )
        finish(query)
        assert query_status(spark, [query]).first().late_rows == (2 if k == 2 else 0)


KEYED = "k int, v string"


def versions(spark, n):
    """Each batch changes some keys."""
    return [[(k, f"{k}@{b}") for k in range(b % 7, 20, 3)] for b in range(n)]


def newest(batches):
    return sorted({k: v for rows in batches for k, v in rows}.items())


def test_compaction_bounds_the_files(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = spark.createDataFrame([], KEYED).schema
    write = compacted.batch_writer(path, schema, ["k"], 4)
    batches = versions(spark, 50)
    assert compacted.read_compacted(spark, path, schema, ["k"]).count() == 0
    for b, rows in enumerate(batches):
        write(spark.createDataFrame(rows, KEYED).coalesce(1), b)
        if b % 9 == 0 or b == 49:
            got = compacted.read_compacted(spark, path, schema, ["k"])
            assert sorted(tuple(r) for r in got.collect()) == newest(batches[: b + 1])
    folders = [p for p in tmp_path.rglob("slot=*") if p.is_dir()]
    assert len(folders) <= 2 * 4 + 2 + 2
    assert len(list(tmp_path.rglob("*.parquet"))) <= 8 + 2 * 4 + 2


@pytest.mark.parametrize("step", ["base", "manifest"])
def test_a_crash_in_mid_compaction_is_harmless(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "out")
    schema = spark.createDataFrame([], KEYED).schema
    write = compacted.batch_writer(path, schema, ["k"], 2)
    from pyspark.sql.readwriter import DataFrameWriter

    plain, batches = DataFrameWriter.parquet, versions(spark, 8)

    def dies(self, at, *args, **kwargs):
        if f"/{step}/" in at:
            if step == "base":
                plain(self, at, *args, **kwargs)  # written, and then lost before the manifest
            raise OSError("lost")
        return plain(self, at, *args, **kwargs)

    for b, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, KEYED).coalesce(1)
        if b % 2:
            with monkeypatch.context() as m:
                m.setattr(DataFrameWriter, "parquet", dies)
                with pytest.raises(OSError, match="lost"):
                    write(frame, b)
            got = compacted.read_compacted(spark, path, schema, ["k"])
            assert sorted(tuple(r) for r in got.collect()) == newest(batches[: b + 1])
        write(frame, b)
        write(frame, b)
        got = compacted.read_compacted(spark, path, schema, ["k"])
        assert sorted(tuple(r) for r in got.collect()) == newest(batches[: b + 1])
    with pytest.raises(RuntimeError, match="not in its base"):
        write(frame, 20)
    with pytest.raises(ValueError, match="every"):
        compacted.batch_writer(path, schema, ["k"], 0)
