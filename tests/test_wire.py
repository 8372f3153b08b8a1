import random
import re
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.pytext import python_text, python_texts
from tripflow.operators.wire import decode_full_rides, decode_rides, encode_rides
from tripflow.schemas import GREEN, HIGH_VOLUME, RIDE_WIRE_COLUMNS


def test_python_text_matches_str(spark):
    vals = [0.0, -0.0, 2.5, 1e7, 12345678.9, 1e16, 1.5e16, 1e-4, 1.234e-5, 0.001, float("nan"), float("inf"), None, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", python_text("x", T.DoubleType()).alias("t")).collect():
        assert r.t == str(r.x)
    ts = spark.createDataFrame([(datetime(2020, 1, 5, 8, 0),), (datetime(2020, 1, 5, 8, 0, 0, 5),)], "t timestamp_ntz")
    for r in ts.select("t", python_text("t", T.TimestampNTZType()).alias("s")).collect():
        assert r.s == str(r.t)


GREEN_WIRE_SCHEMA = (
    "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "DOLocationID int, trip_distance double, fare_amount double, mta_tax double, tip_amount double, "
    "tolls_amount double, congestion_surcharge double"
)


def test_encode_equals_python_join(spark):
    rows = [
        (2, datetime(2020, 1, 5, 8), datetime(2020, 1, 5, 8, 12, 30), 74, 168, 2.5, 11.0, 0.5, 2.0, 0.0, None),
        (None, None, datetime(2020, 1, 5, 8, 0, 0, 250000), None, 1, float("nan"), 1e7, None, 0.1, 3.0, 2.75),
    ]
    df = spark.createDataFrame(rows, GREEN_WIRE_SCHEMA)
    got = encode_rides(df, GREEN).collect()
    for row, rec in zip(df.collect(), got):
        assert rec.value == ", ".join(str(row[c]) for c in GREEN.wire_columns)
        assert rec.key == str(row["VendorID"])
    assert got[0].value == "2, 2020-01-05 08:00:00, 2020-01-05 08:12:30, 74, 168, 2.5, 11.0, 0.5, 2.0, 0.0, None"


def test_high_volume_encodes_its_own_columns(spark):
    schema = (
        "hvfhs_license_num string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, "
        "DOLocationID int, trip_miles double, base_passenger_fare double, sales_tax double, tips double, tolls double, "
        "congestion_surcharge double"
    )
    df = spark.createDataFrame([("HV0003", datetime(2022, 1, 1), datetime(2022, 1, 1, 0, 30), 1, 2, 3.5, 20.0, 1.5, 2.0, 0.0, 2.75)], schema)
    rec = encode_rides(df, HIGH_VOLUME).first()
    assert rec.key == "HV0003"
    assert rec.value == "HV0003, 2022-01-01 00:00:00, 2022-01-01 00:30:00, 1, 2, 3.5, 20.0, 1.5, 2.0, 0.0, 2.75"


def test_decode_edge_lines(spark):
    lines = [
        ("2, 2020-01-05 08:00:00, 2020-01-05 08:12:30, 74, 168, 2.5, 11.0, 0.5, 2.0, 0.0, None",),
        ("None, None, None, None, None, None, None, None, None, None, None",),
        ("1,2020-01-05 08:00:00,2020-01-05 08:01:00,1,2,nan,3,4,5,6,7",),
        ("1, 2020-01-05 08:00:00",),
        ("1, 2020-01-05 08:00:00, 2020-01-05 08:01:00, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10",),
        ("",),
    ]
    df = spark.createDataFrame(lines, "value string")
    out = decode_rides(df).collect()
    assert out[0].VendorID == "2" and out[0].PULocationID == 74 and out[0].congestion_surcharge is None
    assert out[0].pickup_datetime == datetime(2020, 1, 5, 8)
    assert out[1].VendorID == "None" and all(out[1][c] is None for c in RIDE_WIRE_COLUMNS[1:])
    assert out[2].trip_distance != out[2].trip_distance  # 'nan' parses as float NaN
    assert out[2].congestion_surcharge == 7.0
    assert out[3].pickup_datetime == datetime(2020, 1, 5, 8) and out[3].dropoff_datetime is None
    assert out[3].congestion_surcharge is None
    assert out[4].congestion_surcharge == 8.0  # extra fields ignored
    assert out[5].VendorID == "" and out[5].pickup_datetime is None


def test_decode_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b"7, 2020-01-05 08:00:00, 2020-01-05 08:01:00, 1, 2, 1.5, 3, 4, 5, 6, 7"),)], "value binary")
    r = decode_rides(df).first()
    assert r.VendorID == "7" and r.trip_distance == 1.5


def test_roundtrip_keeps_every_field(spark):
    rows = [
        (2, datetime(2020, 1, 5, 8), datetime(2020, 1, 5, 8, 12, 30), 74, 168, 2.5, 11.0, 0.5, 2.0, 0.0, None),
        (None, datetime(2020, 1, 5, 8, 0, 0, 1), None, None, 1, None, 1e7, None, 0.125, 3.0, 2.75),
    ]
    df = spark.createDataFrame(rows, GREEN_WIRE_SCHEMA)
    back = decode_rides(encode_rides(df, GREEN)).collect()
    for src, dec in zip(df.collect(), back):
        for s, w in zip(GREEN.wire_columns, RIDE_WIRE_COLUMNS):
            a, b = src[s], dec[w]
            if w == "VendorID":
                assert b == str(a)
            elif a is None:
                assert b is None
            elif isinstance(a, float):
                assert abs(b - a) <= abs(a) * 1e-6
            else:
                assert b == a


def test_full_line_decode(spark):
    line = "1, 2020-01-05 08:00:00, 2020-01-05 08:30:00, 2, 3.25, 1, N, 74, 168, 1, 11.5, 0.5, 0.5, 2.0, 0.0, 0.3, 14.8, 2.5"
    short = "2, bad time, 2020-01-05 08:30:00, x"
    out = decode_full_rides(spark.createDataFrame([(line,), (short,)], "value string")).collect()
    r = out[0]
    assert r.vendor_id == "1" and r.tpep_pickup_datetime == datetime(2020, 1, 5, 8)
    assert r.passenger_count == 2 and r.trip_distance == Decimal("3.2500")
    assert r.store_and_fwd_flag == "N" and r.payment_type == "1" and r.total_amount == Decimal("14.8000")
    s = out[1]
    assert s.tpep_pickup_datetime is None and s.passenger_count is None and s.congestion_surcharge is None


def test_fields_split_without_a_regular_expression(spark):
    """Any white space after a comma goes, as by the pattern ``,\\s*``, which no row compiles."""
    space = ["", " ", "  ", "\t", "\r\n", " \x0b\f", "\u00a0", "\x00"]
    rng = random.Random(3)
    full = ["1", "2020-01-05 08:00:00", "2020-01-05 08:30:00", "2", "3.25", "1", "N x ", "74", "168", "1 "]
    full += ["11.5", ".5", "-0.5", "2e1", "", "None", "14.8", "2.5", "extra"]
    short = ["7 ", "2020-01-05 08:00:00", "2020-01-05T08:01:00.5", "1", "2 ", "nan", "3", "inf", "5.5", "", "None"]
    for fields, decode in ((full, decode_full_rides), (short, decode_rides)):
        lines = [rng.choice(space) + "".join(f + "," + rng.choice(space) for f in fields) for _ in range(300)]
        lines += ["", ",", " , ,", ", ,, ", fields[0], *(line[: rng.randrange(len(line))] for line in lines[:100])]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
        # the same fields with nothing around the commas
        clean = [(i, ",".join(re.split(r",\s*", v, flags=re.ASCII))) for i, v in enumerate(lines)]
        want = decode(spark.createDataFrame(clean, df.schema), keep=["i"]).orderBy("i").collect()
        out = decode(df, keep=["i"])
        assert str(out.orderBy("i").collect()) == str(want)
        assert "\\s" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_python_text_equals_str_over_the_guaranteed_range(spark):
    import random

    rnd = random.Random(11)
    vals = [rnd.choice([1, -1]) * 10 ** rnd.uniform(-99, 15.99) for _ in range(3000)]
    vals += [round(rnd.uniform(-1e6, 1e6), 2) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    bad = [(r.x, r.t) for r in df.select("x", python_text("x", T.DoubleType()).alias("t")).collect() if r.t != str(r.x)]
    assert bad == []


def test_python_texts_equal_str_over_all_doubles(spark):
    """Random bit patterns of all exponents, money, large whole numbers, and the known hard cases."""
    import struct

    rng = random.Random(9)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(8000)]
    values += [rng.choice((1, -1)) * 10 ** rng.uniform(-6, 18.9) for _ in range(3000)]
    values += [round(rng.uniform(0, 1e6), 2) for _ in range(1000)]
    values += [0.0, -0.0, 5e-324, 1e-323, 2.2250738585072014e-308, 1.7976931348623157e308, 1e16, 9999999999999998.0, 1e23]
    values += [9.999999999999999e22, 123456789012345680.0, 1e-4, 1e-5, 2e-3, 1e7, 2.0**53, 2.0**60, 2.0**-44, 1 / 3]
    values += [float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").withColumn("f", F.col("x").cast("float"))
    got = python_texts(df, ["x", "f", "i"]).collect()
    off = [r for r in got if r["_text_x"] != str(values[r.i])]
    # beyond what fits a long a last digit may be one off, never a digit too many
    for r in off:
        assert abs(values[r.i]) > 9.2e18 and float(r["_text_x"]) == values[r.i] and len(r["_text_x"]) == len(str(values[r.i]))
    assert len(off) <= 3
    assert all(r["_text_f"] == str(r.f) and r["_text_i"] == str(r.i) for r in got)
