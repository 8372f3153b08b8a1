"""Bit sets of bounded size, built and tested with built-in functions only.

A set of positions below ``bits`` is a table of at most ``bits / 32768 + 1``
rows (``bucket``, ``bitmap`` of 4 KB), so that broadcasting it costs at most
``bits / 8`` bytes however many rows the tables have. A test may answer
"set" for a key that was never added (two keys on one position); it never
answers "not set" for a key that was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 27


def position(key: Column, bits: int, seed: int = 0) -> Column:
    """Position of a key in a set of ``bits`` positions."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))


def bit_set(positions: DataFrame, column: str) -> DataFrame:
    """The set of the positions in ``column``, as rows (bucket, bitmap)."""
    p = F.col(column)
    return positions.groupBy(F.bitmap_bucket_number(p).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(p)).alias("bitmap")
    )


def with_test(df: DataFrame, pos: str, bits: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: is the position in column ``pos`` in the set?

    The set is broadcast; ``df`` does not move.
    """
    small = bits.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    at = F.bitmap_bit_position(F.col(pos))
    byte = F.conv(F.hex(F.substring("_bitmap", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(F.col(pos))).join(
        F.broadcast(small), "_bucket", "left"
    )
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_bucket", "_bitmap")
