from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripflow.functions.timecols import month_bounds
from tripflow.operators.clean import clean_month, clean_months
from tripflow.schemas import GREEN, HIGH_VOLUME, YELLOW


@pytest.mark.parametrize(
    "year,month,last",
    [(1996, 2, 29), (1997, 2, 28), (2020, 4, 30), (2021, 1, 31), (2024, 2, 29), (1900, 2, 28)],
)
def test_month_bounds_all_month_lengths(year, month, last):
    start, end = month_bounds(year, month)
    assert start == datetime(year, month, 1, 0, 0, 0)
    assert end == datetime(year, month, last, 23, 59, 59)


GREEN_SCHEMA = (
    "id int, VendorID long, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
    "PULocationID long, DOLocationID double, passenger_count long, payment_type string, "
    "congestion_surcharge string, fare_amount double"
)


def _green_rows():
    d = datetime
    return [
        (1, 1, d(2024, 2, 1, 0, 0, 0), d(2024, 2, 1, 0, 10), 10, 20.0, 1, "1", "2.5", 5.0),  # day 1 midnight
        (2, 2, d(2024, 2, 29, 23, 0), d(2024, 2, 29, 23, 59, 59), 10, 20.0, 1, "2", None, 5.0),  # last second
        (3, 2, d(2024, 2, 29, 23, 0), d(2024, 3, 1, 0, 0, 0), 10, 20.0, 1, "2", None, 5.0),  # crosses month end
        (4, 6, d(2024, 1, 31, 23, 0), d(2024, 2, 1, 0, 5), 10, 20.0, 1, "x", None, 5.0),  # other month start
        (5, 3, d(2024, 2, 10), d(2024, 2, 10, 1), 10, 20.0, 1, "1", None, 5.0),  # vendor not listed
        (6, None, d(2024, 2, 10), d(2024, 2, 10, 1), 10, 20.0, 1, "1", None, 5.0),  # null vendor
        (7, 7, d(2024, 2, 10), d(2024, 2, 10, 1), 10, 20.0, 1, "1", None, 5.0),  # 7: green drops
        (8, 6, None, d(2024, 2, 10, 1), 10, 20.0, 1, "1", None, 5.0),  # null pickup
        (9, 2, d(2024, 2, 15), d(2024, 2, 15, 1), 3_000_000_000, 7.9, None, "junk", "nan", 5.0),
    ]


def test_clean_green_month_edges(spark):
    df = spark.createDataFrame(_green_rows(), GREEN_SCHEMA)
    out = clean_month(df, GREEN, 2024, 2)
    kept = {r.id: r for r in out.collect()}
    assert sorted(kept) == [1, 2, 9]
    types = dict(out.dtypes)
    assert types["VendorID"] == "int" and types["PULocationID"] == "int"
    assert types["DOLocationID"] == "int" and types["payment_type"] == "int"
    assert types["passenger_count"] == "double" and types["congestion_surcharge"] == "double"
    # out-of-range bigint and junk text become null instead of failing the job
    assert kept[9].PULocationID is None and kept[9].payment_type is None
    assert kept[9].DOLocationID == 7
    assert kept[1].congestion_surcharge == 2.5


def test_clean_yellow_keeps_vendor_7(spark):
    rows = [(r[0], r[1], r[2], r[3], *r[4:]) for r in _green_rows()]
    schema = GREEN_SCHEMA.replace("lpep_", "tpep_")
    out = clean_month(spark.createDataFrame(rows, schema), YELLOW, 2024, 2)
    assert sorted(r.id for r in out.collect()) == [1, 2, 7, 9]


HV_SCHEMA = (
    "id int, hvfhs_license_num string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "PULocationID long, DOLocationID long, trip_miles double, base_passenger_fare double, tolls double, "
    "sales_tax double, congestion_surcharge double, airport_fee double, tips double"
)


def test_clean_high_volume_licences_and_fill(spark):
    d = datetime
    p, q = d(2023, 4, 10), d(2023, 4, 10, 1)
    nan = float("nan")
    rows = [
        (1, "HV0003", p, q, 1, 2, 3.0, 10.0, None, 1.0, nan, None, 2.0),
        (2, "HV0009", p, q, 1, 2, 3.0, 10.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (3, "", p, q, 1, 2, 3.0, 10.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (4, None, p, q, 1, 2, 3.0, 10.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (5, "HVabcX", p, q, 1, 2, 3.0, 10.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (6, "HV0005", p, d(2023, 5, 1), 1, 2, 3.0, None, None, None, None, None, None),
        (7, "HV0002", d(2023, 4, 30, 23), d(2023, 4, 30, 23, 59, 59), 1, 2, 3.0, nan, nan, nan, nan, nan, nan),
    ]
    out = clean_month(spark.createDataFrame(rows, HV_SCHEMA), HIGH_VOLUME, 2023, 4)
    got = {r.id: r for r in out.collect()}
    assert sorted(got) == [1, 7]
    assert got[1].hvfhs_license_num == 3
    assert got[1].tolls == 0.0 and got[1].congestion_surcharge == 0.0 and got[1].airport_fee == 0.0
    assert all(
        getattr(got[7], c) == 0.0
        for c in ("base_passenger_fare", "tolls", "sales_tax", "congestion_surcharge", "airport_fee", "tips")
    )


def test_clean_months_agrees_with_clean_month(spark):
    rows = [r + (2024, 2) for r in _green_rows()] + [
        (10, 1, datetime(2024, 3, 5), datetime(2024, 3, 5, 1), 1, 1.0, 1, "1", None, 1.0, 2024, 3),
        (11, 1, datetime(2024, 3, 5), datetime(2024, 3, 5, 1), 1, 1.0, 1, "1", None, 1.0, 2024, 2),
    ]
    df = spark.createDataFrame(rows, GREEN_SCHEMA + ", year int, month int")
    many = {r.id for r in clean_months(df, GREEN).collect()}
    feb = {r.id for r in clean_month(df.filter("month = 2"), GREEN, 2024, 2).collect()}
    mar = {r.id for r in clean_month(df.filter("month = 3"), GREEN, 2024, 3).collect()}
    assert many == feb | mar
    assert 10 in many and 11 not in many  # a March trip inside February's folder is dropped


def test_vendor_filter_reaches_parquet_scan(spark, tmp_path):
    df = spark.createDataFrame(_green_rows(), GREEN_SCHEMA)
    path = str(tmp_path / "g")
    df.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = clean_month(spark.read.parquet(path), GREEN, 2024, 2)._jdf.queryExecution().executedPlan().toString()
    assert "In(VendorID, [1,2,6])" in plan
    assert "GreaterThanOrEqual(lpep_pickup_datetime" in plan
    out = clean_month(spark.read.parquet(path), GREEN, 2024, 2)
    assert sorted(r.id for r in out.collect()) == [1, 2, 9]


def test_vendor_cast_then_filter_for_text_vendor(spark):
    rows = [("1", datetime(2024, 2, 2), datetime(2024, 2, 2, 1)), ("1.0", datetime(2024, 2, 2), datetime(2024, 2, 2, 1)), ("x", datetime(2024, 2, 2), datetime(2024, 2, 2, 1))]
    df = spark.createDataFrame(rows, "VendorID string, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz")
    out = clean_month(df, GREEN, 2024, 2).collect()
    # text vendors parse as numbers ("1.0" -> 1, as older non-ANSI casts did); junk is dropped
    assert [r.VendorID for r in out] == [1, 1]
    assert F is not None


def test_type_drift_between_month_files(spark):
    from pyspark.sql import types as T

    from tripflow.session import scratch_path
    from tripflow.sources.parquet import month_folders, read_months_merged

    root = scratch_path(spark, "drift")
    d = datetime
    jan = spark.createDataFrame(
        [(1, d(2019, 1, 5), d(2019, 1, 5, 1), 10, 20, 1.5), (4, d(2019, 1, 6), d(2019, 1, 6, 1), 10, 20, None)],
        "VendorID long, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "PULocationID long, DOLocationID long, congestion_surcharge double",
    )
    feb = spark.createDataFrame(
        [(2.0, d(2019, 2, 5), d(2019, 2, 5, 1), 11.0, 21.0)],
        "VendorID double, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "PULocationID double, DOLocationID double",
    )
    mar = spark.createDataFrame(
        [("6", d(2019, 3, 5), d(2019, 3, 5, 1), " 12 ", "x", "2.75"), ("2.0", d(2019, 3, 7), d(2019, 3, 7, 1), "12", "13", None)],
        "VendorID string, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "PULocationID string, DOLocationID string, congestion_surcharge string",
    )
    for m, df in ((1, jan), (2, feb), (3, mar)):
        df.write.parquet(f"{root}/green/2019/{m:02d}/")
    assert [(y, m) for y, m, _ in month_folders(spark, root, GREEN, [2019])] == [(2019, 1), (2019, 2), (2019, 3)]
    raw = read_months_merged(spark, root, GREEN, [2019])
    assert raw.schema["congestion_surcharge"].dataType == T.DoubleType()
    got = sorted(clean_months(raw, GREEN).collect(), key=lambda r: r.lpep_pickup_datetime)
    assert [(r.VendorID, r.PULocationID, r.DOLocationID, r.congestion_surcharge, r.month) for r in got] == [
        (1, 10, 20, 1.5, 1),
        (2, 11, 21, None, 2),
        (6, 12, None, 2.75, 3),
        (2, 12, 13, None, 3),
    ]
