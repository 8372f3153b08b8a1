"""Property tests (hypothesis) and catalog-table write modes."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripflow.operators.clean import clean_month
from tripflow.operators.unify import to_common, union_services
from tripflow.operators.wire import decode_rides, encode_rides
from tripflow.schemas import GREEN, RIDE_WIRE_COLUMNS, YELLOW
from tripflow.sinks.writers import write_details, write_report

SCHEMA = (
    "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "DOLocationID int, trip_distance double, fare_amount double, mta_tax double, tip_amount double, "
    "tolls_amount double, congestion_surcharge double"
)

money = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32, min_value=-1e6, max_value=1e6))
ints = st.one_of(st.none(), st.integers(min_value=-(2**31), max_value=2**31 - 1))
times = st.one_of(
    st.none(),
    st.datetimes(min_value=datetime(1990, 1, 1), max_value=datetime(2030, 1, 1)),
)
row = st.tuples(ints, times, times, ints, ints, money, money, money, money, money, money)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(row, min_size=1, max_size=60))
def test_wire_roundtrip_property(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    back = decode_rides(encode_rides(df, GREEN)).collect()
    assert len(back) == len(rows)
    for src, dec in zip(rows, back):
        for value, name in zip(src, RIDE_WIRE_COLUMNS):
            got = dec[name]
            if name == "VendorID":
                assert got == str(value)
            elif value is None:
                assert got is None
            elif isinstance(value, float):
                assert got == pytest.approx(value, rel=1e-6, abs=1e-30)
            else:
                assert got == value


def _trips(spark, n, seed):
    import random

    rnd = random.Random(seed)
    base = datetime(2024, 2, 1)
    rows = []
    for i in range(n):
        p = base + timedelta(minutes=rnd.randint(-600, 29 * 24 * 60 + 600))
        rows.append(
            (rnd.choice([None, 1, 2, 3, 6, 7]), p, p + timedelta(minutes=rnd.randint(0, 600)), i % 50, 1,
             float(rnd.randint(1, 5)), 1.0, 10.0, 0.5, 0.5, 1.0, 0.0, 0.3, 12.3, "1", rnd.choice([None, 2.5]))
        )
    schema = (
        "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID int, "
        "DOLocationID int, passenger_count double, trip_distance double, fare_amount double, extra double, "
        "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
        "payment_type string, congestion_surcharge double"
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("seed", [1, 2])
def test_clean_is_idempotent_and_satisfies_rules(spark, seed):
    raw = _trips(spark, 400, seed)
    once = clean_month(raw, GREEN, 2024, 2)
    twice = clean_month(once, GREEN, 2024, 2)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    bad = once.filter(
        ~F.col("VendorID").isin(1, 2, 6)
        | (F.col("lpep_pickup_datetime") < F.lit("2024-02-01").cast("timestamp_ntz"))
        | (F.col("lpep_dropoff_datetime") > F.lit("2024-02-29 23:59:59").cast("timestamp_ntz"))
    )
    assert bad.count() == 0


def test_union_count_is_sum_of_counts(spark):
    g = clean_month(_trips(spark, 300, 3), GREEN, 2024, 2)
    y = clean_month(
        _trips(spark, 300, 4).withColumnsRenamed(
            {"lpep_pickup_datetime": "tpep_pickup_datetime", "lpep_dropoff_datetime": "tpep_dropoff_datetime"}
        ),
        YELLOW,
        2024,
        2,
    )
    u = union_services([to_common(g, GREEN), to_common(y, YELLOW)])
    assert u.count() == g.count() + y.count()


def test_catalog_table_write_modes(spark):
    trips = to_common(clean_month(_trips(spark, 200, 5), GREEN, 2024, 2), GREEN)
    from tripflow.operators.report import zone_month_report

    report = zone_month_report(trips)
    name, details = "tripflow_test_report", "tripflow_test_details"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {details}")
    try:
        write_report(report, name, as_table=True)
        with pytest.raises(AnalysisException):
            write_report(report, name, as_table=True)
        write_report(report, name, mode="overwrite", as_table=True)
        assert spark.table(name).count() == report.count()
        write_details(trips, details, as_table=True)
        write_details(trips, details, as_table=True)
        assert spark.table(details).count() == 2 * trips.count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {details}")
