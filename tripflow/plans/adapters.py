"""Driver tables as trip and ride data.

The test and bench tables are an order/line-item star schema and an event
log, not taxi trips. These adapters are pure projections (no shuffle, no
Python) that give them the shapes the pipeline reads, so every registered
query runs over the whole tables and grows with them. The same mappings
are spelled out in SQL in ``plans/catalog.py`` for the oracle.

``lineitem`` -> raw trips of one service, chosen by ``l_returnflag``
(R green, A yellow, N high volume); a row's folder month is the month of
``l_shipdate + (l_linenumber - 4) days``, so some trips start before or end
after their folder month and cleaning has work to do.

Pickup zones are folded to 200, with a third of the trips in one zone;
payment types are text, ``1`` to ``6`` with some junk.

``events`` -> rides: vendor ``user_id % 7 + 1`` as text, pickup ``ts``,
drop-off ``ts + floor(value)`` seconds, fare ``value * 10``, distance
``15 * k`` from the JSON props, surcharge 2.75 on errors and null
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.schemas import ServiceSpec, service

# Fixed values of the mapping (shared with the oracle SQL).
SERVICE_BY_RETURNFLAG = {"green": "R", "yellow": "A", "high volume": "N"}
LICENCE_PREFIX = "HV000"
ZONES, HOT_ZONE = 200, 132
SURCHARGE_EVENT = "error"
SURCHARGE_VALUE = 2.75


def _dropoff() -> Column:
    return F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_quantity").cast("int"))


def _folder() -> dict[str, Column]:
    shifted = F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber") - 4)
    return {"year": F.year(shifted), "month": F.month(shifted)}


def _zone() -> Column:
    folded = F.col("l_suppkey") % ZONES + 1
    return F.when(F.col("l_orderkey") % 3 == 0, F.lit(HOT_ZONE).cast("long")).otherwise(folded)


def _payment() -> Column:
    code = (F.col("l_orderkey") % 6 + 1).cast("string")
    return F.when(F.col("l_partkey") % 50 == 0, F.lit("unknown")).otherwise(code)


def raw_trips_from_lineitem(lineitem: DataFrame, spec: ServiceSpec | str) -> DataFrame:
    """Raw trips of one service with ``year``/``month`` folder columns."""
    spec = service(spec)
    li = lineitem.filter(F.col("l_returnflag") == SERVICE_BY_RETURNFLAG[spec.name])
    folder = _folder()
    if spec.licence_digit:
        return li.select(
            F.concat(F.lit(LICENCE_PREFIX), F.col("l_linenumber").cast("string")).alias(
                "hvfhs_license_num"
            ),
            F.col("l_shipdate").alias("pickup_datetime"),
            _dropoff().alias("dropoff_datetime"),
            _zone().alias("PULocationID"),
            F.col("l_partkey").alias("DOLocationID"),
            F.col("l_quantity").alias("trip_miles"),
            F.col("l_extendedprice").alias("base_passenger_fare"),
            F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tolls"),
            F.col("l_tax").alias("sales_tax"),
            F.col("l_tax").alias("congestion_surcharge"),
            F.col("l_discount").alias("airport_fee"),
            F.col("l_discount").alias("tips"),
            folder["year"].alias("year"),
            folder["month"].alias("month"),
        )
    return li.select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("l_shipdate").alias(spec.pickup_col),
        _dropoff().alias(spec.dropoff_col),
        _zone().alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_tax").alias("tolls_amount"),
        F.col("l_discount").alias("improvement_surcharge"),
        F.col("l_extendedprice").alias("total_amount"),
        _payment().alias("payment_type"),
        F.col("l_tax").alias("congestion_surcharge"),
        folder["year"].alias("year"),
        folder["month"].alias("month"),
    )


def _event_fields() -> dict[str, Column]:
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    return {
        "VendorID": ((F.col("user_id") % 7) + 1).cast("string"),
        "pickup": F.col("ts"),
        "dropoff": F.col("ts")
        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("value"))),
        "PULocationID": F.col("user_id").cast("int"),
        "DOLocationID": F.col("user_id").cast("int"),
        "trip_distance": (k * 15).cast("double"),
        "fare_amount": (F.col("value").cast("decimal(18,2)") * 10).cast("decimal(18,2)"),
        "mta_tax": F.lit(0.0),
        "tip_amount": F.col("value"),
        "tolls_amount": F.lit(0.0),
        "congestion_surcharge": F.when(
            F.col("event_type") == SURCHARGE_EVENT, F.lit(SURCHARGE_VALUE)
        ).cast("double"),
    }


def rides_from_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed rides (wire field names) with event time as ``timestamp``.

    Watermarks need ``timestamp``, not ``timestamp_ntz``; with the session
    time zone at UTC the instants are unchanged. ``keep`` carries source
    columns along (e.g. ``event_id``).
    """
    f = _event_fields()
    return events.select(
        *(keep or []),
        f["VendorID"].alias("VendorID"),
        f["pickup"].cast("timestamp").alias("pickup_datetime"),
        f["dropoff"].cast("timestamp").alias("dropoff_datetime"),
        f["PULocationID"].alias("PULocationID"),
        f["DOLocationID"].alias("DOLocationID"),
        f["trip_distance"].alias("trip_distance"),
        f["fare_amount"].alias("fare_amount"),
        f["mta_tax"].alias("mta_tax"),
        f["tip_amount"].alias("tip_amount"),
        f["tolls_amount"].alias("tolls_amount"),
        f["congestion_surcharge"].alias("congestion_surcharge"),
    )


def green_trips_from_events(events: DataFrame) -> DataFrame:
    """Cleaned green trips (source names) built from events, for encoding."""
    f = _event_fields()
    return events.select(
        F.col("event_id"),
        ((F.col("user_id") % 7) + 1).cast("int").alias("VendorID"),
        f["pickup"].alias("lpep_pickup_datetime"),
        f["dropoff"].alias("lpep_dropoff_datetime"),
        f["PULocationID"].alias("PULocationID"),
        f["DOLocationID"].alias("DOLocationID"),
        f["trip_distance"].cast("int").alias("trip_distance"),
        f["fare_amount"].alias("fare_amount"),
        F.lit(0).alias("mta_tax"),
        F.col("value").cast("decimal(18,2)").alias("tip_amount"),
        F.lit(0).alias("tolls_amount"),
        f["congestion_surcharge"].cast("decimal(18,2)").alias("congestion_surcharge"),
    )
