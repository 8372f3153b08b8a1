"""Ride records on a message topic: encode, decode, full-line decode.

Wire form: ``key`` = vendor id as text, ``value`` = the 11 ride fields as
``str(v)`` joined by ``", "``; null travels as the text ``None``. All of it
is built and parsed with Spark expressions on the executors, so publishing
and consuming scale with the cluster; nothing passes through the driver.

Decoding splits on a comma followed by any white space, takes field ``i``
with ``get`` (null when the line is short; extra fields are ignored) and
casts with ``try_cast`` (``None``, ``nan`` as text of an int, or junk give
null). ``VendorID`` stays text. The split itself is at the bare comma, which
needs no regular expression; white space after it is trimmed from fields
that stay text or are read by a format, and casts skip it themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.pytext import python_texts
from tripflow.schemas import RIDE_FULL_FIELDS, RIDE_WIRE_COLUMNS, RIDE_WIRE_TYPES, ServiceSpec, service

WIRE_SEPARATOR = ", "
WIRE_SPLIT_PATTERN = ","
# White space that may follow the comma.
WIRE_SPACE = " \t\n\x0b\f\r"
FULL_DECIMAL = "decimal(18,4)"
FULL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def encode_rides(df: DataFrame, spec: ServiceSpec | str, keep: list[str] | None = None) -> DataFrame:
    """``(key, value)`` text records for a service's trips.

    ``keep`` names extra columns to carry along (e.g. an id for checks).
    """
    spec = service(spec)
    missing = [c for c in spec.wire_columns if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name} trips lack wire columns {missing}")
    columns = list(dict.fromkeys([spec.vendor_col, *spec.wire_columns]))
    texts = python_texts(df.select(*dict.fromkeys([*(keep or []), *columns])), columns)
    value = F.concat_ws(WIRE_SEPARATOR, *(F.col(f"_text_{c}") for c in spec.wire_columns))
    return texts.select(*(keep or []), F.col(f"_text_{spec.vendor_col}").alias("key"), value.alias("value"))


def _text(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def wire_parts(value: str | Column = "value") -> Column:
    """The fields, but for the first with the white space that follows the comma."""
    return F.split(_text(value), WIRE_SPLIT_PATTERN)


def _trimmed(item: Column, i: int) -> Column:
    """Field ``i`` without the white space that follows its comma (the first field has none before it)."""
    return F.ltrim(item, F.lit(WIRE_SPACE)) if i else item


def decode_rides(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Wire text (string or binary ``value``) -> 11 named, typed ride columns."""
    parts = wire_parts(value)
    cols = []
    for i, name in enumerate(RIDE_WIRE_COLUMNS):
        item = F.get(parts, F.lit(i))
        dtype = RIDE_WIRE_TYPES[name]
        cols.append((_trimmed(item, i) if dtype == "string" else item.try_cast(dtype)).alias(name))
    return df.select(*(keep or []), *cols)


def decode_full_rides(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The 18-field ride line -> typed columns; money as ``decimal(18,4)``,
    times in ``yyyy-MM-dd HH:mm:ss``."""
    parts = wire_parts(value)
    cols = []
    for i, (name, kind) in enumerate(RIDE_FULL_FIELDS):
        item = F.get(parts, F.lit(i))
        if kind == "string":
            c = _trimmed(item, i)
        elif kind == "timestamp":
            c = F.try_to_timestamp(_trimmed(item, i), F.lit(FULL_TIME_FORMAT))
        elif kind == "decimal":
            c = item.try_cast(FULL_DECIMAL)
        else:
            c = item.try_cast(kind)
        cols.append(c.alias(name))
    return df.select(*(keep or []), *cols)


def kafka_records(encoded: DataFrame, topic: str | None = None) -> DataFrame:
    """Encoded rides in the shape the Kafka sink writes (binary-compatible
    strings; optional ``topic`` column for multi-topic writes)."""
    cols = [F.col("key").cast(T.StringType()), F.col("value").cast(T.StringType())]
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return encoded.select(*cols)
