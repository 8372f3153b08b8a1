"""DuckDB SQL for every registered query: the independent oracle.

Written from the semantics (not generated from the Spark plans): adapters,
cleaning rules and metrics are restated in plain SQL over the driver's
tables. Money sums are exact decimal sums cast to double, as in the Spark
queries, so both sides give the same bits.
"""

from __future__ import annotations

# --- adapters -------------------------------------------------------------

_DROPOFF = "l_shipdate + to_hours(CAST(l_quantity AS INTEGER))"
_FOLDER_DATE = "(CAST(l_shipdate AS DATE) + (l_linenumber - 4))"
_FOLDER = (
    f"CAST(year({_FOLDER_DATE}) AS INTEGER) AS year, "
    f"CAST(month({_FOLDER_DATE}) AS INTEGER) AS month"
)


_ZONE = "CASE WHEN l_orderkey % 3 = 0 THEN 132 ELSE l_suppkey % 200 + 1 END"
_PAYMENT = "CASE WHEN l_partkey % 50 = 0 THEN 'unknown' ELSE CAST(l_orderkey % 6 + 1 AS VARCHAR) END"


def raw_sql(service: str) -> str:
    """Raw trips of a service from lineitem (same mapping as the adapter)."""
    if service == "high volume":
        return (
            "SELECT 'HV000' || CAST(l_linenumber AS VARCHAR) AS hvfhs_license_num, "
            f"l_shipdate AS pickup_datetime, {_DROPOFF} AS dropoff_datetime, "
            f"{_ZONE} AS PULocationID, l_partkey AS DOLocationID, "
            "l_quantity AS trip_miles, l_extendedprice AS base_passenger_fare, "
            "nullif(l_tax, 0.0) AS tolls, l_tax AS sales_tax, l_tax AS congestion_surcharge, "
            f"l_discount AS airport_fee, l_discount AS tips, {_FOLDER} "
            "FROM lineitem WHERE l_returnflag = 'N'"
        )
    prefix = "lpep" if service == "green" else "tpep"
    flag = "R" if service == "green" else "A"
    return (
        f"SELECT l_linenumber AS VendorID, l_shipdate AS {prefix}_pickup_datetime, "
        f"{_DROPOFF} AS {prefix}_dropoff_datetime, "
        f"{_ZONE} AS PULocationID, l_partkey AS DOLocationID, "
        "CAST(l_linenumber AS DOUBLE) AS passenger_count, l_quantity AS trip_distance, "
        "l_extendedprice AS fare_amount, l_discount AS extra, l_tax AS mta_tax, "
        "l_discount AS tip_amount, l_tax AS tolls_amount, l_discount AS improvement_surcharge, "
        f"l_extendedprice AS total_amount, {_PAYMENT} AS payment_type, "
        f"l_tax AS congestion_surcharge, {_FOLDER} "
        f"FROM lineitem WHERE l_returnflag = '{flag}'"
    )


def _fill(c: str) -> str:
    return f"COALESCE(CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END, 0.0) AS {c}"


def clean_sql(service: str, month_filter: str | None, keep_folder: bool) -> str:
    """Cleaned trips. ``month_filter`` = (year, month) of one folder, or None
    for all folders with the bounds computed from ``year``/``month``."""
    raw = raw_sql(service)
    if service == "high volume":
        pick, drop, vend = "pickup_datetime", "dropoff_datetime", "hvfhs_license_num"
        vendor_expr = "TRY_CAST(substring(hvfhs_license_num, 6, 1) AS INTEGER)"
        vendors = "2, 3, 4, 5"
    else:
        prefix = "lpep" if service == "green" else "tpep"
        pick, drop, vend = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime", "VendorID"
        vendor_expr = "TRY_CAST(VendorID AS INTEGER)"
        vendors = "1, 2, 6" if service == "green" else "1, 2, 6, 7"
    if month_filter:
        y, m = month_filter.split("-")
        import calendar

        last = calendar.monthrange(int(y), int(m))[1]
        bounds = (
            f"year = {int(y)} AND month = {int(m)} "
            f"AND {pick} >= TIMESTAMP '{y}-{m}-01 00:00:00' "
            f"AND {drop} <= TIMESTAMP '{y}-{m}-{last:02d} 23:59:59'"
        )
    else:
        start = "make_timestamp(year, month, 1, 0, 0, 0)"
        bounds = (
            f"{pick} >= {start} AND "
            f"{drop} <= {start} + INTERVAL 1 MONTH - INTERVAL 1 SECOND"
        )
    if service == "high volume":
        cols = [
            f"{vendor_expr} AS hvfhs_license_num",
            "pickup_datetime",
            "dropoff_datetime",
            "TRY_CAST(PULocationID AS INTEGER) AS PULocationID",
            "TRY_CAST(DOLocationID AS INTEGER) AS DOLocationID",
            "trip_miles",
        ] + [
            _fill(c)
            for c in (
                "base_passenger_fare",
                "tolls",
                "sales_tax",
                "congestion_surcharge",
                "airport_fee",
                "tips",
            )
        ]
    else:
        cols = [
            f"{vendor_expr} AS VendorID",
            pick,
            drop,
            "TRY_CAST(PULocationID AS INTEGER) AS PULocationID",
            "TRY_CAST(DOLocationID AS INTEGER) AS DOLocationID",
            "CAST(passenger_count AS DOUBLE) AS passenger_count",
            "trip_distance",
            "fare_amount",
            "extra",
            "mta_tax",
            "tip_amount",
            "tolls_amount",
            "improvement_surcharge",
            "total_amount",
            "TRY_CAST(payment_type AS INTEGER) AS payment_type",
            "CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge",
        ]
    if keep_folder:
        cols += ["year", "month"]
    return (
        f"SELECT {', '.join(cols)} FROM ({raw}) AS r "
        f"WHERE {vendor_expr} IN ({vendors}) AND {bounds}"
    )


# Output columns of the unified trips and measures of the reports.
TRIP_COLS = [
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
CORE_COLS = [
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


def common_sql(service: str, core: bool, extra_cols: str = "") -> str:
    """Cleaned (all months) trips of a service in the unified shape."""
    cleaned = clean_sql(service, None, keep_folder=bool(extra_cols))
    cols = CORE_COLS if core else TRIP_COLS
    if service == "high volume":
        rename = {
            "VendorID": "hvfhs_license_num",
            "trip_distance": "trip_miles",
            "tip_amount": "tips",
            "tolls_amount": "tolls",
            "mta_tax": "sales_tax",
            "fare_amount": "base_passenger_fare",
        }
        exprs = []
        for c in cols:
            if c == "payment_type":
                exprs.append("'credit_card' AS payment_type")
            elif c == "total_amount":
                exprs.append(
                    "base_passenger_fare + tolls + sales_tax + congestion_surcharge "
                    "+ airport_fee + tips AS total_amount"
                )
            elif c in rename:
                exprs.append(f"{rename[c]} AS {c}")
            else:
                exprs.append(c)
    else:
        prefix = "lpep" if service == "green" else "tpep"
        exprs = []
        for c in cols:
            if c == "pickup_datetime":
                exprs.append(f"{prefix}_pickup_datetime AS pickup_datetime")
            elif c == "dropoff_datetime":
                exprs.append(f"{prefix}_dropoff_datetime AS dropoff_datetime")
            elif c == "payment_type":
                exprs.append("CAST(payment_type AS VARCHAR) AS payment_type")
            else:
                exprs.append(c)
    tail = f", {extra_cols}" if extra_cols else ""
    return f"SELECT {', '.join(exprs)}, '{service}' AS service_type{tail} FROM ({cleaned}) AS c"


def unified_sql(services: list[str], core: bool, extra_cols: str = "") -> str:
    return " UNION ALL ".join(f"({common_sql(s, core, extra_cols)})" for s in services)


REPORT_FULL = [
    ("sum", "fare_amount", "revenue_monthly_fare"),
    ("sum", "extra", "revenue_monthly_extra"),
    ("sum", "mta_tax", "revenue_monthly_mta_tax"),
    ("sum", "tip_amount", "revenue_monthly_tip_amount"),
    ("sum", "tolls_amount", "revenue_monthly_tolls_amount"),
    ("sum", "improvement_surcharge", "revenue_monthly_improvement_surcharge"),
    ("sum", "total_amount", "revenue_monthly_total_amount"),
    ("sum", "congestion_surcharge", "revenue_monthly_congestion_surcharge"),
    ("avg", "passenger_count", "avg_monthly_passenger_count"),
    ("avg", "trip_distance", "avg_monthly_trip_distance"),
]
REPORT_CORE = [m for m in REPORT_FULL if m[1] not in ("extra", "improvement_surcharge", "passenger_count")]


def _exact(kind: str, col: str) -> str:
    # each value to a hundredth of a cent, summed exactly (the rule of the Spark side)
    s = f"CAST(SUM(CAST({col} AS DECIMAL(18,4))) AS DOUBLE)"
    return s if kind == "sum" else f"{s} / COUNT({col})"


def report_sql(services: list[str], core: bool) -> str:
    # plain sums; the queries round money sums on output, as float noise depends on the order of rows
    measures = REPORT_CORE if core else REPORT_FULL
    aggs = ", ".join(f"round(sum({c}), 2) AS {a}" if k == "sum" else f"avg({c}) AS {a}" for k, c, a in measures)
    return (
        "SELECT PULocationID AS revenue_zone, "
        "CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month, "
        f"service_type, {aggs} FROM ({unified_sql(services, core)}) AS t GROUP BY 1, 2, 3"
    )


# --- rides from events ------------------------------------------------------

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_EV_DROPOFF = "ts + to_seconds(CAST(floor(value) AS BIGINT))"
_EV_FARE = "CAST(CAST(value AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2))"
_EV_SURCHARGE = "CASE WHEN event_type = 'error' THEN 2.75 END"

RIDES_SQL = (
    "SELECT event_id, CAST(user_id % 7 + 1 AS VARCHAR) AS VendorID, ts AS pickup_datetime, "
    f"{_EV_DROPOFF} AS dropoff_datetime, CAST(user_id AS INTEGER) AS PULocationID, "
    f"CAST(user_id AS INTEGER) AS DOLocationID, CAST({_K} * 15 AS DOUBLE) AS trip_distance, "
    f"{_EV_FARE} AS fare_amount, 0.0 AS mta_tax, value AS tip_amount, 0.0 AS tolls_amount, "
    f"CAST({_EV_SURCHARGE} AS DOUBLE) AS congestion_surcharge, event_type FROM events"
)


def _pytext_ts(c: str) -> str:
    return (
        f"CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%d %H:%M:%S') "
        f"ELSE strftime({c}, '%Y-%m-%d %H:%M:%S.%f') END"
    )


GREEN_EVENTS_SQL = (
    "SELECT event_id, CAST(user_id % 7 + 1 AS INTEGER) AS VendorID, ts AS p, "
    f"{_EV_DROPOFF} AS d, CAST(user_id AS INTEGER) AS pu, CAST(user_id AS INTEGER) AS dl, "
    f"CAST({_K} * 15 AS INTEGER) AS dist, {_EV_FARE} AS fare, 0 AS mta, "
    f"CAST(value AS DECIMAL(18,2)) AS tip, 0 AS tolls, CAST({_EV_SURCHARGE} AS DECIMAL(18,2)) AS cs "
    "FROM events"
)


def _none(c: str) -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), 'None')"


WIRE_ENCODE_SQL = (
    f"SELECT event_id, {_none('VendorID')} AS key, concat_ws(', ', {_none('VendorID')}, "
    f"COALESCE({_pytext_ts('p')}, 'None'), COALESCE({_pytext_ts('d')}, 'None'), "
    f"{_none('pu')}, {_none('dl')}, {_none('dist')}, {_none('fare')}, {_none('mta')}, "
    f"{_none('tip')}, {_none('tolls')}, {_none('cs')}) AS value FROM ({GREEN_EVENTS_SQL}) AS g"
)

PUBLISH_REPEATED_SQL = (
    "SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY ts, value) - 1 AS number "
    f"FROM ({WIRE_ENCODE_SQL}) AS w JOIN (SELECT event_id, ts FROM events) AS e USING (event_id)"
)

WIRE_DECODE_SQL = (
    "SELECT event_id, CAST(VendorID AS VARCHAR) AS VendorID, p AS pickup_datetime, "
    "d AS dropoff_datetime, pu AS PULocationID, dl AS DOLocationID, "
    "CAST(dist AS FLOAT) AS trip_distance, CAST(fare AS FLOAT) AS fare_amount, "
    "CAST(mta AS FLOAT) AS mta_tax, CAST(tip AS FLOAT) AS tip_amount, "
    "CAST(tolls AS FLOAT) AS tolls_amount, CAST(cs AS FLOAT) AS congestion_surcharge "
    f"FROM ({GREEN_EVENTS_SQL}) AS g"
)

WIRE_ROUNDTRIP_SQL = (
    "SELECT COUNT(*) AS rides, COUNT(*) AS rides_equal, "
    "COUNT(*) FILTER (WHERE event_type <> 'error') AS none_tokens FROM events"
)

_D4 = "DECIMAL(18,4)"
WIRE_DECODE_FULL_SQL = (
    "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS VARCHAR) AS vendor_id, "
    "l_shipdate AS tpep_pickup_datetime, "
    f"{_DROPOFF} AS tpep_dropoff_datetime, "
    "l_linenumber AS passenger_count, "
    f"CAST(CAST(l_quantity AS DECIMAL(18,2)) AS {_D4}) AS trip_distance, "
    "CAST(l_orderkey % 6 + 1 AS INTEGER) AS rate_code_id, l_linestatus AS store_and_fwd_flag, "
    "CAST(l_suppkey AS INTEGER) AS pu_location_id, CAST(l_partkey AS INTEGER) AS do_location_id, "
    "l_returnflag AS payment_type, "
    f"CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {_D4}) AS fare_amount, "
    f"CAST(CAST(l_discount AS DECIMAL(18,2)) AS {_D4}) AS extra, "
    f"CAST(CAST(l_tax AS DECIMAL(18,2)) AS {_D4}) AS mta_tax, "
    f"CAST(CAST(l_discount AS DECIMAL(18,2)) AS {_D4}) AS tip_amount, "
    f"CAST(CAST(l_tax AS DECIMAL(18,2)) AS {_D4}) AS tolls_amount, "
    f"CAST(CAST(l_discount AS DECIMAL(18,2)) AS {_D4}) AS improvement_surcharge, "
    f"CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {_D4}) AS total_amount, "
    f"CAST(CAST(l_tax AS DECIMAL(18,2)) AS {_D4}) AS congestion_surcharge "
    "FROM lineitem"
)


def _money(kind: str, c: str) -> str:
    return _exact(kind, c)


RUNNING_TOTALS_SQL = (
    f"SELECT COUNT(*) AS total_trips, {_money('sum', 'fare_amount')} AS total_revenue "
    f"FROM ({RIDES_SQL}) AS r"
)


def window_metrics_sql(append: bool = False) -> str:
    having = ""
    if append:
        having = (
            " HAVING time_bucket(INTERVAL '5 minutes', pickup_datetime) + INTERVAL '5 minutes' "
            "<= (SELECT max(ts) FROM events) - INTERVAL '5 minutes'"
        )
    return (
        "SELECT time_bucket(INTERVAL '5 minutes', pickup_datetime) AS window_start, "
        "time_bucket(INTERVAL '5 minutes', pickup_datetime) + INTERVAL '5 minutes' AS window_end, "
        "COUNT(*) AS total_trips_last_month, "
        f"{_money('sum', 'fare_amount')} AS total_revenue_last5mins, "
        f"{_money('avg', 'fare_amount')} AS avg_revenue_last_5mins, "
        f"{_money('avg', 'tip_amount')} AS avg_tip, "
        f"{_money('avg', 'trip_distance')} AS avg_trip_distance_last_5mins, "
        "avg(epoch(date_trunc('second', dropoff_datetime)) - epoch(date_trunc('second', pickup_datetime))) "
        "AS avg_trip_duration_seconds_last_5mins "
        f"FROM ({RIDES_SQL}) AS r GROUP BY 1, 2{having}"
    )


RIDE_COLS = (
    "VendorID, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_distance, "
    "fare_amount, mta_tax, tip_amount, tolls_amount, congestion_surcharge"
)

ANOMALIES_SQL = (
    f"SELECT event_id, {RIDE_COLS}, CASE WHEN fare_amount > 1000 THEN 'High amount' "
    "WHEN trip_distance > 1000 THEN 'Long trip' ELSE 'No anomaly' END AS Anomaly "
    f"FROM ({RIDES_SQL}) AS r WHERE trip_distance > 1000 OR fare_amount > 1000"
)

SURCHARGED_SQL = (
    "SELECT COUNT(*) AS trips_with_surcharge_count "
    f"FROM ({RIDES_SQL}) AS r WHERE congestion_surcharge > 0"
)

PEAK_WINDOWS_SQL = (
    "SELECT time_bucket(INTERVAL '30 minutes', pickup_datetime) AS pickup_window_start, "
    "time_bucket(INTERVAL '30 minutes', pickup_datetime) + INTERVAL '30 minutes' AS pickup_window_end, "
    "COUNT(*) AS trip_count, "
    "row_number() OVER (ORDER BY COUNT(*) DESC, time_bucket(INTERVAL '30 minutes', pickup_datetime)) AS busiest "
    f"FROM ({RIDES_SQL}) AS r GROUP BY 1, 2"
)


PEAK_ZONE_WINDOWS_SQL = (
    "SELECT PULocationID, time_bucket(INTERVAL '30 minutes', pickup_datetime) AS window_start, "
    "time_bucket(INTERVAL '30 minutes', pickup_datetime) + INTERVAL '30 minutes' AS window_end, COUNT(*) AS trip_count, "
    "row_number() OVER (ORDER BY COUNT(*) DESC, time_bucket(INTERVAL '30 minutes', pickup_datetime), PULocationID) AS busiest "
    f"FROM ({RIDES_SQL}) AS r GROUP BY 1, 2, 3"
)


def wire_encode_sql(service: str) -> str:
    """Cleaned trips of a service as records; doubles print with their shortest digits."""
    if service == "high volume":
        cols = "hvfhs_license_num pickup_datetime dropoff_datetime PULocationID DOLocationID trip_miles base_passenger_fare sales_tax tips tolls congestion_surcharge"
    else:
        cols = (
            "VendorID tpep_pickup_datetime tpep_dropoff_datetime PULocationID DOLocationID trip_distance fare_amount "
            "mta_tax tip_amount tolls_amount congestion_surcharge"
        )
    names = cols.split()
    texts = [f"COALESCE({_pytext_ts(c)}, 'None')" if c.endswith("datetime") else _none(c) for c in names]
    return f"SELECT {texts[0]} AS key, concat_ws(', ', {', '.join(texts)}) AS value FROM ({clean_sql(service, None, keep_folder=False)}) AS c"


def recent_rides_sql(span: str) -> str:
    return (
        f"SELECT event_id, {RIDE_COLS} FROM ({RIDES_SQL}) AS r "
        f"WHERE pickup_datetime >= (SELECT max(ts) FROM events) - INTERVAL '{span}'"
    )


# --- write / read back --------------------------------------------------------

READBACK_SQL = clean_sql("green", None, keep_folder=True)

FIXED_SCHEMA_SQL = (
    "SELECT VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, "
    "CAST(NULL AS VARCHAR) AS store_and_fwd_flag, CAST(NULL AS BIGINT) AS RatecodeID, "
    "TRY_CAST(PULocationID AS INTEGER) AS PULocationID, TRY_CAST(DOLocationID AS INTEGER) AS DOLocationID, "
    "passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
    "CAST(NULL AS INTEGER) AS ehail_fee, improvement_surcharge, total_amount, "
    "TRY_CAST(payment_type AS INTEGER) AS payment_type, CAST(NULL AS DOUBLE) AS trip_type, "
    "congestion_surcharge FROM (" + raw_sql("green") + ") AS r"
)

DETAILS_SQL = (
    "SELECT service_type, 2 * COUNT(*) AS rows_append, COUNT(*) AS rows_replace, "
    "COUNT(*) FILTER (WHERE NOT (date_trunc('month', pickup_datetime) = TIMESTAMP '1996-02-01' "
    "AND trip_distance < 10)) AS rows_month_replaced FROM ("
    + unified_sql(["green", "yellow"], core=False)
    + ") AS t GROUP BY 1"
)

# Answers of the five metrics: number of rows, and of trips in them.
ANSWERS_SQL = (
    "SELECT 'running_totals' AS name, 1 AS answer_rows, COUNT(*) AS answer_trips FROM events "
    f"UNION ALL SELECT 'window_metrics', COUNT(*), sum(total_trips_last_month)::BIGINT FROM ({window_metrics_sql()}) AS w "
    f"UNION ALL SELECT 'surcharged_trips', 1, trips_with_surcharge_count FROM ({SURCHARGED_SQL}) AS s "
    f"UNION ALL SELECT 'anomalies', COUNT(*), COUNT(*) FROM ({ANOMALIES_SQL}) AS a "
    f"UNION ALL SELECT 'peak_windows', COUNT(*), sum(trip_count)::BIGINT FROM ({PEAK_WINDOWS_SQL}) AS p"
)

MULTI_STATUS_SQL = (
    "SELECT name, false AS is_active, (SELECT COUNT(*) FROM events) AS input_rows, answer_rows, answer_trips "
    f"FROM ({ANSWERS_SQL}) AS q"
)

ONE_READ_SQL = f"SELECT name, answer_rows, answer_trips, (SELECT COUNT(*) FROM events) AS input_rows FROM ({ANSWERS_SQL}) AS q"

# Months of one year; in odd months the files also have a column ``note``.
DRIFTING_SQL = (
    f"SELECT c.*, CASE WHEN month % 2 = 1 THEN 'n' || CAST(l_quantity AS INTEGER) END AS note FROM ("
    + clean_sql("green", None, keep_folder=True).replace("SELECT ", "SELECT trip_distance AS l_quantity, ", 1)
    + ") AS c WHERE year = 1996"
)

ONE_MONTH_SQL = "SELECT * EXCLUDE (year, month) FROM (" + raw_sql("green") + ") AS r WHERE year = 1996 AND month = 2"

MONTH_FILES_SQL = (
    "SELECT 4 AS files, COUNT(*) AS trips, sum(PULocationID)::BIGINT AS zones FROM ("
    + clean_sql("green", "1996-02", keep_folder=False)
    + ") AS c"
)


def late_data_sql(late_type: str = "view", split_day: int = 20) -> str:
    """Window metrics when ``late_type`` events arrive after all others:
    such a row counts only if its window ends after the watermark left by
    the earlier deliveries (newest on-time pickup, millisecond precision,
    minus the 5-minute delay)."""
    wm = (
        "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' "
        f"FROM events WHERE event_type <> '{late_type}')"
    )
    rides = RIDES_SQL
    kept = (
        f"SELECT * FROM ({rides}) AS r WHERE event_type <> '{late_type}' OR "
        f"time_bucket(INTERVAL '5 minutes', pickup_datetime) + INTERVAL '5 minutes' > {wm}"
    )
    return window_metrics_sql().replace(f"FROM ({RIDES_SQL}) AS r", f"FROM ({kept}) AS k")


def late_rows_sql(late_type: str = "view") -> str:
    """How many rides came too late for their window, and what the windows hold without them."""
    end = "time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'"
    return (
        f"SELECT (SELECT COUNT(*) FROM events) AS input_rows, (SELECT COUNT(*) FROM events WHERE event_type = '{late_type}' "
        f"AND {end} <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' FROM events "
        f"WHERE event_type <> '{late_type}')) AS late_rows, COUNT(*) AS windows, "
        f"sum(total_trips_last_month)::BIGINT AS window_trips FROM ({late_data_sql(late_type)}) AS w"
    )
