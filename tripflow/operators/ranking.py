"""Numbering rows in a global order without one task for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import scratch_path


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with the row number (from 1) in the order of ``order``, as column ``name``.

    Rows are range-partitioned by the order and written once (so that retried
    tasks see the same ranges); each range is numbered for itself, and the
    counts of the ranges before it are added. ``order`` should tell rows apart:
    equal rows of the order lie in one range, numbered in any order. Only one
    count a range reaches the driver.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranked")
    ranged = df.repartitionByRange(count, *order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    held = spark.read.schema(ranged.schema).parquet(path)
    sizes = {r["_range"]: r["count"] for r in held.groupBy("_range").count().collect()}
    before, offsets = 0, []
    for k in sorted(sizes):
        offsets.append((k, before))
        before += sizes[k]
    starts = spark.createDataFrame(offsets, "_range int, _before long")
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        held.join(F.broadcast(starts), "_range")
        .withColumn(name, number.cast("long") + F.col("_before"))
        .drop("_range", "_before")
    )
