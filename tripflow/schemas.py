"""Canonical schemas and one specification per trip service.

The column lists, vendor lists and service labels below are fixed values:
results are only comparable with the original pipeline when they are
exactly these.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's)
# ---------------------------------------------------------------------------

# Unified trip columns for the two-service report, in order.
TRIP_COLUMNS = [
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "payment_type",
    "congestion_surcharge",
]

# Unified trip columns when the high-volume service takes part, in order.
TRIP_CORE_COLUMNS = [
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "payment_type",
    "congestion_surcharge",
]

# Ride record on the wire: 11 fields joined by ", ", in this order.
RIDE_WIRE_COLUMNS = [
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "congestion_surcharge",
]

# Full 18-field ride line, in this order.
RIDE_FULL_FIELDS = [
    ("vendor_id", "string"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "int"),
    ("trip_distance", "decimal"),
    ("rate_code_id", "int"),
    ("store_and_fwd_flag", "string"),
    ("pu_location_id", "int"),
    ("do_location_id", "int"),
    ("payment_type", "string"),
    ("fare_amount", "decimal"),
    ("extra", "decimal"),
    ("mta_tax", "decimal"),
    ("tip_amount", "decimal"),
    ("tolls_amount", "decimal"),
    ("improvement_surcharge", "decimal"),
    ("total_amount", "decimal"),
    ("congestion_surcharge", "decimal"),
]

GREEN_VENDORS = [1, 2, 6]
YELLOW_VENDORS = [1, 2, 6, 7]
HIGH_VOLUME_LICENCES = [2, 3, 4, 5]

# The six high-volume money columns that cleaning casts to double and fills with 0.
HIGH_VOLUME_FILL_COLUMNS = [
    "base_passenger_fare",
    "tolls",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
    "tips",
]

# High-volume names -> unified names.
HIGH_VOLUME_RENAMES = {
    "hvfhs_license_num": "VendorID",
    "trip_miles": "trip_distance",
    "tips": "tip_amount",
    "tolls": "tolls_amount",
    "sales_tax": "mta_tax",
    "base_passenger_fare": "fare_amount",
}

# Addends of the derived high-volume total (after renaming).
HIGH_VOLUME_TOTAL_ADDENDS = [
    "fare_amount",
    "tolls_amount",
    "mta_tax",
    "congestion_surcharge",
    "airport_fee",
    "tip_amount",
]

HIGH_VOLUME_PAYMENT_TYPE = "credit_card"

# Declared green schema of the three-service report (20 fields).
GREEN_FIXED_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("lpep_pickup_datetime", T.TimestampType()),
        T.StructField("lpep_dropoff_datetime", T.TimestampType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("ehail_fee", T.IntegerType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("trip_type", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

_TRIP_TYPES = {
    "VendorID": T.IntegerType(),
    "pickup_datetime": T.TimestampNTZType(),
    "dropoff_datetime": T.TimestampNTZType(),
    "PULocationID": T.IntegerType(),
    "DOLocationID": T.IntegerType(),
    "payment_type": T.StringType(),
}


def trip_schema(columns: list[str] = TRIP_COLUMNS) -> T.StructType:
    """Unified schema: the given columns plus ``service_type``."""
    fields = [T.StructField(c, _TRIP_TYPES.get(c, T.DoubleType())) for c in columns]
    return T.StructType(fields + [T.StructField("service_type", T.StringType())])


TRIP = trip_schema(TRIP_COLUMNS)
TRIP_CORE = trip_schema(TRIP_CORE_COLUMNS)

RIDE_WIRE_TYPES = {
    "VendorID": "string",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "PULocationID": "int",
    "DOLocationID": "int",
    "trip_distance": "float",
    "fare_amount": "float",
    "mta_tax": "float",
    "tip_amount": "float",
    "tolls_amount": "float",
    "congestion_surcharge": "float",
}


@dataclass(frozen=True)
class ServiceSpec:
    """Everything that differs between trip services.

    ``wire_columns`` are the 11 source columns that encode a ride in the
    order of ``RIDE_WIRE_COLUMNS``.
    """

    name: str  # value of service_type
    folder: str  # folder name under the data root
    vendor_col: str
    vendors: list[int]
    pickup_col: str
    dropoff_col: str
    int_cols: list[str]
    double_cols: list[str]
    fill_cols: list[str] = field(default_factory=list)
    renames: dict[str, str] = field(default_factory=dict)
    licence_digit: bool = False  # vendor comes from the 6th character of a licence
    wire_columns: list[str] = field(default_factory=list)


GREEN = ServiceSpec(
    name="green",
    folder="green",
    vendor_col="VendorID",
    vendors=GREEN_VENDORS,
    pickup_col="lpep_pickup_datetime",
    dropoff_col="lpep_dropoff_datetime",
    int_cols=["VendorID", "PULocationID", "DOLocationID", "payment_type"],
    double_cols=["passenger_count", "congestion_surcharge"],
    renames={
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
    wire_columns=[
        "VendorID",
        "lpep_pickup_datetime",
        "lpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "fare_amount",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "congestion_surcharge",
    ],
)

YELLOW = ServiceSpec(
    name="yellow",
    folder="yellow",
    vendor_col="VendorID",
    vendors=YELLOW_VENDORS,
    pickup_col="tpep_pickup_datetime",
    dropoff_col="tpep_dropoff_datetime",
    int_cols=["VendorID", "PULocationID", "DOLocationID", "payment_type"],
    double_cols=["passenger_count", "congestion_surcharge"],
    renames={
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    wire_columns=[
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "fare_amount",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "congestion_surcharge",
    ],
)

HIGH_VOLUME = ServiceSpec(
    name="high volume",
    folder="fhvhv",
    vendor_col="hvfhs_license_num",
    vendors=HIGH_VOLUME_LICENCES,
    pickup_col="pickup_datetime",
    dropoff_col="dropoff_datetime",
    int_cols=["hvfhs_license_num", "PULocationID", "DOLocationID"],
    double_cols=list(HIGH_VOLUME_FILL_COLUMNS),
    fill_cols=list(HIGH_VOLUME_FILL_COLUMNS),
    renames=dict(HIGH_VOLUME_RENAMES),
    licence_digit=True,
    wire_columns=[
        "hvfhs_license_num",
        "pickup_datetime",
        "dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "trip_miles",
        "base_passenger_fare",
        "sales_tax",
        "tips",
        "tolls",
        "congestion_surcharge",
    ],
)

SERVICES = {spec.name: spec for spec in (GREEN, YELLOW, HIGH_VOLUME)}
SERVICE_ALIASES = {"fhvhv": HIGH_VOLUME, "hv": HIGH_VOLUME, "high_volume": HIGH_VOLUME}


def service(name: str | ServiceSpec) -> ServiceSpec:
    """Look a service up by name or folder; unknown names raise."""
    if isinstance(name, ServiceSpec):
        return name
    spec = SERVICES.get(name) or SERVICE_ALIASES.get(name)
    if spec is None:
        raise ValueError(f"unknown service {name!r}; expected one of {sorted(SERVICES)}")
    return spec


def raw_schema(spec: ServiceSpec | str) -> T.StructType:
    """Declared schema of a service's raw monthly files, for ``read_with_schema``.

    Green is the declared 20-field schema; yellow is the same with the
    ``tpep_`` time names and without the green-only ``ehail_fee`` and
    ``trip_type``; the high-volume schema holds the columns its cleaning
    and unification read.
    """
    spec = service(spec)
    if spec.name == "green":
        return GREEN_FIXED_SCHEMA
    if spec.name == "yellow":
        fields = []
        for f in GREEN_FIXED_SCHEMA.fields:
            if f.name in ("ehail_fee", "trip_type"):
                continue
            fields.append(T.StructField(f.name.replace("lpep_", "tpep_"), f.dataType))
        return T.StructType(fields)
    return T.StructType(
        [
            T.StructField("hvfhs_license_num", T.StringType()),
            T.StructField("pickup_datetime", T.TimestampType()),
            T.StructField("dropoff_datetime", T.TimestampType()),
            T.StructField("PULocationID", T.IntegerType()),
            T.StructField("DOLocationID", T.IntegerType()),
            T.StructField("trip_miles", T.DoubleType()),
        ]
        + [T.StructField(c, T.DoubleType()) for c in HIGH_VOLUME_FILL_COLUMNS]
    )
