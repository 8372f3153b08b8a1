"""Helpers of the vector operators: integer vectors, sums by group, skew-safe joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integer components are kept within this bound, so that squared distances fit 64 bits.
MOST = 1 << 26
# A group with more than rows / HOT_SHARE rows is joined by broadcast (so 511 groups at most).
HOT_SHARE = 512


def finite(vector: Column) -> Column:
    """Is the vector there, without a null, NaN or infinite component?"""
    inner = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & inner, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """Components as integers, ``floor(scale * x)`` within ``MOST`` of zero."""
    bound = F.lit(float(MOST))
    return F.transform(
        vector, lambda x: F.floor(F.greatest(-bound, F.least(bound, F.lit(float(scale)) * x.cast("double")))).cast("int")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def group_sums(keys: np.ndarray, rows: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows a group and their componentwise sums, exact."""
    count = np.bincount(keys, minlength=groups)
    total = np.zeros((groups, rows.shape[1]), dtype=np.int64)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        at = np.flatnonzero(np.diff(keys[order], prepend=-1))
        total[keys[order][at]] = np.add.reduceat(rows[order], at, axis=0)
    return count, total


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group, one row of ``groups`` for each key.

    ``size`` names the group's number of rows. Groups above ``total / HOT_SHARE``
    rows are broadcast (fewer than HOT_SHARE rows), so none gathers in one task.
    """
    most = max(1, total // HOT_SHARE)
    hot = groups.filter(F.col(size) > most).withColumn("_hot", F.lit(True))
    cold = groups.filter(F.col(size) <= most)
    tried = rows.join(F.broadcast(hot), keys, "left")
    rest = tried.filter("_hot IS NULL").select(rows.columns).join(cold, keys)
    return tried.filter("_hot IS NOT NULL").drop("_hot").unionByName(rest)
