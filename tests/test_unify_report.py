from datetime import datetime

from pyspark.sql import functions as F

from tripflow.operators.report import (
    REPORT_CORE_MEASURES,
    REPORT_MEASURES,
    zone_month_report,
    zone_month_report_sql,
)
from tripflow.operators.unify import to_common, union_services, unify
from tripflow.schemas import GREEN, HIGH_VOLUME, TRIP, TRIP_CORE_COLUMNS, YELLOW


def _green(spark):
    rows = [
        (1, datetime(2024, 1, 3, 8), datetime(2024, 1, 3, 9), 10, 20, 1.0, 2.0, 10.25, 0.5, 0.5, 1.0, 0.0, 0.3, 12.55, 1, 2.5),
        (2, datetime(2024, 1, 20, 8), datetime(2024, 1, 20, 9), 10, 20, 3.0, 4.0, 20.10, 0.5, 0.5, 2.0, 0.0, 0.3, 23.40, 2, None),
        (2, datetime(2024, 2, 1, 0), datetime(2024, 2, 1, 1), 11, 20, None, 1.0, 5.0, 0.0, 0.5, 0.0, 0.0, 0.3, 5.8, 1, 0.0),
    ]
    schema = (
        "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "PULocationID int, DOLocationID int, passenger_count double, trip_distance double, fare_amount double, "
        "extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, payment_type int, congestion_surcharge double"
    )
    return spark.createDataFrame(rows, schema)


def _yellow(spark):
    g = _green(spark)
    return g.withColumnsRenamed(
        {"lpep_pickup_datetime": "tpep_pickup_datetime", "lpep_dropoff_datetime": "tpep_dropoff_datetime"}
    )


def _hv(spark):
    rows = [
        (3, datetime(2024, 1, 5), datetime(2024, 1, 5, 1), 10, 30, 7.5, 30.0, 1.0, 2.0, 2.75, 0.0, 5.0),
        (4, datetime(2024, 1, 6), datetime(2024, 1, 6, 1), 10, 30, 2.5, 10.0, 0.0, 1.0, 0.0, 1.25, 0.0),
    ]
    schema = (
        "hvfhs_license_num int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
        "PULocationID int, DOLocationID int, trip_miles double, base_passenger_fare double, tolls double, "
        "sales_tax double, congestion_surcharge double, airport_fee double, tips double"
    )
    return spark.createDataFrame(rows, schema)


def test_to_common_schema_and_service(spark):
    out = to_common(_green(spark), GREEN)
    assert out.columns == [f.name for f in TRIP.fields]
    assert dict(out.dtypes)["payment_type"] == "string"
    assert {r.service_type for r in out.collect()} == {"green"}


def test_high_volume_renames_total_and_payment(spark):
    out = to_common(_hv(spark), HIGH_VOLUME).collect()
    assert out[0].VendorID == 3 and out[0].trip_distance == 7.5 and out[0].fare_amount == 30.0
    assert out[0].total_amount == 30.0 + 1.0 + 2.0 + 2.75 + 0.0 + 5.0
    assert {r.payment_type for r in out} == {"credit_card"}
    assert {r.service_type for r in out} == {"high volume"}


def test_total_is_null_when_an_addend_is_null(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0, 1.0, None, 1.0), (1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
        "base_passenger_fare double, tolls double, sales_tax double, congestion_surcharge double, airport_fee double, tips double",
    )
    got = [r.total_amount for r in to_common(df, HIGH_VOLUME, ["total_amount"]).collect()]
    assert got == [None, 6.0]


def test_union_of_three_keeps_every_service(spark):
    frames = {"green": _green(spark), "yellow": _yellow(spark), "high volume": _hv(spark)}
    out = unify(frames)
    assert out.columns == TRIP_CORE_COLUMNS + ["service_type"]
    counts = {r.service_type: r["count"] for r in out.groupBy("service_type").count().collect()}
    assert counts == {"green": 3, "yellow": 3, "high volume": 2}


def test_report_values_and_sql_twin(spark):
    trips = union_services([to_common(_green(spark), GREEN), to_common(_yellow(spark), YELLOW)])
    rep = zone_month_report(trips, REPORT_MEASURES)
    rows = {(r.revenue_zone, r.revenue_month, r.service_type): r for r in rep.collect()}
    jan = rows[(10, datetime(2024, 1, 1), "green")]
    assert jan.revenue_monthly_fare == 30.35
    assert jan.revenue_monthly_total_amount == 35.95
    assert jan.revenue_monthly_congestion_surcharge == 2.5  # null skipped
    assert jan.avg_monthly_passenger_count == 2.0
    feb = rows[(11, datetime(2024, 2, 1), "green")]
    assert feb.avg_monthly_passenger_count is None  # only nulls
    assert len(rows) == 4
    sql = zone_month_report_sql(spark, trips, "trips_data", REPORT_MEASURES)
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, rep.collect()))


def test_report_totals_equal_detail_totals(spark):
    frames = {"green": _green(spark), "yellow": _yellow(spark), "high volume": _hv(spark)}
    trips = unify(frames)
    rep = zone_month_report(trips, REPORT_CORE_MEASURES)
    a = rep.agg(F.sum("revenue_monthly_fare")).first()[0]
    b = trips.agg(F.sum("fare_amount")).first()[0]
    assert round(a, 6) == round(b, 6)


def test_exact_sums_do_not_depend_on_partitioning(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    df = spark.createDataFrame(vals, "fare_amount double")
    from tripflow.functions.money import exact_sum

    one = df.coalesce(1).agg(exact_sum("fare_amount")).first()[0]
    many = df.repartition(7).agg(exact_sum("fare_amount")).first()[0]
    assert one == many == 600.0


def test_exact_sum_rules(spark):
    from tripflow.functions.money import exact_avg, exact_sum

    def agg(df):
        out = df.groupBy("g").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()
        return {r.g: (r.s, r.a) for r in out}

    floats = agg(spark.createDataFrame([("a", 123.45), ("a", 0.1), ("a", None)], "g string, x float"))
    # values are taken to six decimals; nulls are skipped
    assert floats["a"] == (123.549997, 123.549997 / 2)
    doubles = agg(
        spark.createDataFrame(
            [("b", float("nan")), ("b", 1.0), ("c", 2e22), ("c", 1.0), *[("d", 9e13)] * 12, *[("e", 0.00004)] * 1000],
            "g string, x double",
        )
    )
    # NaN and out-of-range values fall back to the plain double sum
    assert doubles["b"][0] != doubles["b"][0]
    assert doubles["c"][0] == 2e22 + 1.0
    assert doubles["d"][0] == 12 * 9e13 and doubles["e"][0] == 0.04


def test_sql_twin_follows_the_exact_rules(spark):
    import math

    trips = union_services([to_common(_green(spark), GREEN)])
    trips = trips.withColumn(
        "fare_amount", F.when(F.col("PULocationID") == 11, F.lit(float("nan"))).otherwise(F.col("fare_amount"))
    )
    df_rows = {
        (r.revenue_zone, r.revenue_month): r for r in zone_month_report(trips, REPORT_MEASURES, exact=True).collect()
    }
    sql_rows = {
        (r.revenue_zone, r.revenue_month): r
        for r in zone_month_report_sql(spark, trips, "trips_nan", REPORT_MEASURES, exact=True).collect()
    }
    assert df_rows.keys() == sql_rows.keys()
    for key, a in df_rows.items():
        b = sql_rows[key]
        for name in a.asDict():
            x, y = a[name], b[name]
            if isinstance(x, float) and math.isnan(x):
                assert isinstance(y, float) and math.isnan(y)
            else:
                assert x == y, (key, name, x, y)
    assert math.isnan(df_rows[(11, datetime(2024, 2, 1))].revenue_monthly_fare)


def test_report_sums_are_plain_by_default(spark):
    trips = union_services([to_common(_green(spark), GREEN)]).withColumn("fare_amount", F.lit(9e13))
    many = trips
    for _ in range(5):
        many = many.unionByName(trips)
    total = zone_month_report(many, REPORT_MEASURES).agg(F.sum("revenue_monthly_fare")).first()[0]
    assert total == 9e13 * many.count()
    tiny = trips.withColumn("fare_amount", F.lit(0.00004))
    assert zone_month_report(tiny, REPORT_MEASURES).agg(F.min("revenue_monthly_fare")).first()[0] >= 0.00004
