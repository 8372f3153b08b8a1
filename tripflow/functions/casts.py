"""Null-on-failure casts for raw and wire data (ANSI stays on elsewhere)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def int_from_any(col: Column, src: T.DataType | None = None) -> Column:
    """Integer value of a column stored as any type, null when impossible.

    Text goes through a number first so that ``"2.0"`` and ``" 6 "`` give 2
    and 6 as the non-ANSI casts of older monthly files did; doubles are
    truncated; out-of-range values and junk give null.
    """
    if src is not None and not isinstance(src, T.StringType):
        return col.try_cast("int")
    return F.coalesce(col.try_cast("int"), F.trim(col).try_cast("double").try_cast("int"))


def _cast(col: Column, src: T.DataType, dst: T.DataType) -> Column:
    if src == dst:
        return col
    if isinstance(dst, T.IntegerType):
        return int_from_any(col, src)
    return col.try_cast(dst)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names and order, ``try_cast`` to
    each declared type, missing columns as typed nulls.

    This is the tolerant form of reading with a declared schema: parquet
    files whose physical types differ from the declaration (bigint stored
    where int is declared, say) would fail a strict read.
    """
    return df.select(*conformed(df, schema))


def conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of ``conform``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(_cast(F.col(f.name), have[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return cols
