"""Tables of parts, and the report kept up to date by month."""

import pytest
from pyspark.sql import functions as F

from tripflow.operators.partials import IncrementalReport, month_part
from tripflow.operators.report import REPORT_MEASURES, zone_month_report
from tripflow.plans.catalog import q_unify_two
from tripflow.sinks.parts import PartTable, part_name

SCHEMA = "k int, v string"


@pytest.fixture
def table(spark, tmp_path):
    return PartTable(spark, str(tmp_path / "parts"))


def rows(spark, *values):
    return spark.createDataFrame([(p, k, v) for p, k, v in values], "part string, k int, v string")


def held(table, parts=None):
    return sorted(tuple(r) for r in table.read(SCHEMA, parts).collect())


def test_replace_add_and_remove(spark, table):
    assert held(table) == [] and table.live() == {}
    table.replace(rows(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")), {"a": "one", "b": None})
    assert held(table) == [(1, "x", "a"), (2, "y", "a"), (3, "z", "b")] and table.live() == {"a": "one", "b": None}
    table.replace(rows(spark, ("a", 9, "new")), {"a": "two"})
    assert held(table) == [(3, "z", "b"), (9, "new", "a")] and table.live() == {"a": "two", "b": None}
    # a part without rows goes, also when its other slot still has some
    table.replace(rows(spark), {"a": None})
    assert held(table) == [(3, "z", "b")] and held(table, ["a"]) == []
    table.replace(rows(spark, ("a", 5, "back")), {"a": None, "c": None})
    assert held(table, ["a", "c"]) == [(5, "back", "a")]
    table.replace(rows(spark), {"a": None, "b": None})
    assert held(table) == [] and table.live() == {}


def test_strays_are_refused(spark, table):
    table.replace(rows(spark, ("a", 1, "x")), {"a": None})
    for bad in (rows(spark, ("a", 2, "y"), ("b", 3, "z")), rows(spark, (None, 2, "y"))):
        with pytest.raises(Exception, match="not replaced"):
            table.replace(bad, {"a": None})
        assert held(table) == [(1, "x", "a")]
    with pytest.raises(ValueError, match="name"):
        table.replace(rows(spark), {"a/b": None})
    assert part_name("high volume", 2020, "01") == "high_volume.2020.01"


def test_a_replacement_that_dies_changes_nothing(spark, table, monkeypatch):
    table.replace(rows(spark, ("a", 1, "x"), ("b", 2, "y")), {"a": None, "b": None})

    def dies(*_):
        raise RuntimeError("lost")

    for _ in range(2):
        with monkeypatch.context() as m:
            m.setattr(PartTable, "_commit", dies)
            with pytest.raises(RuntimeError):
                table.replace(rows(spark, ("a", 7, "half")), {"a": None, "b": None})
        assert held(table) == [(1, "x", "a"), (2, "y", "b")]
    table.replace(rows(spark, ("a", 8, "whole")), {"a": None, "b": None})
    assert held(table) == [(8, "whole", "a")]


def test_files_stay_bounded(spark, table, tmp_path):
    for k in range(12):
        table.replace(rows(spark, ("a", k, "x")), {"a": str(k)})
    assert held(table) == [(11, "x", "a")]
    assert len(list((tmp_path / "parts").rglob("*.parquet"))) <= 4


def test_report_by_months(spark, sf_small, tmp_path):
    trips = q_unify_two(spark, sf_small)
    month = F.date_format("pickup_datetime", "yyyy-MM")
    feb, mar, apr = (trips.filter(month == f"1996-0{k}") for k in (2, 3, 4))
    services = ("green", "yellow")
    for exact in (False, True):
        report = IncrementalReport(spark, str(tmp_path / f"report{exact}"), REPORT_MEASURES, exact)
        report.refresh(feb.filter("trip_distance < 10"), [(s, 1996, 2) for s in services])
        report.refresh(mar.unionByName(apr), [(s, 1996, m) for s in services for m in (3, 4)])
        report.refresh(feb, [(s, 1996, 2) for s in services])
        want = zone_month_report(feb.unionByName(mar).unionByName(apr), REPORT_MEASURES, exact=True)
        key = ["revenue_zone", "revenue_month", "service_type"]
        got = report.report()
        assert got.columns == want.columns
        together = got.alias("g").join(want.alias("w"), key, "full")
        for m in REPORT_MEASURES:
            wrong = together.filter(~(F.abs(F.col(f"g.{m.alias}") - F.col(f"w.{m.alias}")) < 1e-6))
            assert wrong.count() == 0
        assert got.count() == want.count() == together.count()
        plan = got._jdf.queryExecution().toString()
        assert "part=" + month_part("green", 1996, 2) in plan or "InMemoryFileIndex" in plan
        assert "lineitem" not in plan and report.table.live().keys() == {month_part(s, 1996, m) for s in services for m in (2, 3, 4)}


def test_exact_report_keeps_odd_values(spark, tmp_path):
    trips = spark.sql(
        "SELECT 1 AS PULocationID, timestamp_ntz'2020-01-02' AS pickup_datetime, 'green' AS service_type, x AS fare_amount "
        "FROM VALUES (double('NaN')), (1.5D) AS t(x) UNION ALL SELECT 2, timestamp_ntz'2020-01-03', 'green', 1e30D "
        "UNION ALL SELECT 3, timestamp_ntz'2020-01-03', 'green', CAST(NULL AS DOUBLE) UNION ALL SELECT 2, timestamp_ntz'2020-01-03', 'green', 2D"
    )
    from tripflow.operators.report import Measure

    measures = [Measure("sum", "fare_amount", "fare"), Measure("avg", "fare_amount", "mean")]
    report = IncrementalReport(spark, str(tmp_path / "odd"), measures, exact=True)
    report.refresh(trips, [("green", 2020, 1)])
    got = {r.revenue_zone: (str(r.fare), str(r.mean)) for r in report.report().collect()}
    assert got == {1: ("nan", "nan"), 2: ("1e+30", "5e+29"), 3: ("None", "None")}


def test_publish_once_is_repeatable(spark, sf_small, tmp_path):
    from tripflow.plans.adapters import green_trips_from_events
    from tripflow.schemas import GREEN
    from tripflow.sinks.repeatable import numbered_records, publish_once, published
    from tripflow.sources.tables import read_table

    trips = green_trips_from_events(read_table(spark, sf_small, "events")).limit(400).unionByName(
        green_trips_from_events(read_table(spark, sf_small, "events")).limit(5)
    )
    trips.write.parquet(str(tmp_path / "trips"))
    trips = spark.read.parquet(str(tmp_path / "trips"))
    want = sorted(tuple(r) for r in numbered_records(trips, GREEN).collect())
    by_key = {}
    for r in trips.select("VendorID", GREEN.pickup_col).collect():
        by_key.setdefault(str(r.VendorID), []).append(r[1])
    assert {k: [w[2] for w in want if w[0] == k] for k in by_key} and len(want) == 405
    for k, times in by_key.items():
        mine = sorted((n, v) for key, v, n in want if key == k)
        assert [n for n, _ in mine] == list(range(len(times)))
        assert [v.split(", ")[1] for _, v in mine] == sorted(str(t) for t in times)
    root = str(tmp_path / "out")
    first = publish_once(spark, trips, GREEN, root, chunk_rows=20)
    assert sorted(tuple(r) for r in published(spark, root).collect()) == want
    assert publish_once(spark, trips, GREEN, root, chunk_rows=20) == []
    # half of it is lost
    lost = first[::2]
    PartTable(spark, root).replace(spark.createDataFrame([], "part string, key string, value string, number long"), dict.fromkeys(lost))
    assert publish_once(spark, trips, GREEN, root, chunk_rows=20) == sorted(lost)
    assert sorted(tuple(r) for r in published(spark, root).collect()) == want
    # to a topic: what was sent and noted isn't sent again
    sent = []
    send = lambda df: sent.extend(tuple(r) for r in df.collect())
    notes = str(tmp_path / "notes")
    assert publish_once(spark, trips, GREEN, notes, 20, send) == first and sorted(sent) == want
    assert publish_once(spark, trips, GREEN, notes, 20, send) == [] and len(sent) == len(want)
