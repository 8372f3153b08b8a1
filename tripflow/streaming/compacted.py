"""An update-mode answer kept in a bounded number of files.

A query in update mode emits a new version of each changed key with every
batch. Here the versions lie in two levels: the recent batches, one folder
each (``recent/slot=``, reused in turn), and a base with one row for each
key (``base/slot=``, two folders in turn). Every ``every`` batches the
recent versions are merged into a new base, newest by key, and a manifest
(one row: which base counts, and up to which batch it holds) is written;
``manifest/slot=`` alternates too and the higher version counts. A reader
takes the base that the manifest names and the recent batches after it.

A crash leaves the manifest, the base that it names and the batches after
it untouched: a batch that is replayed overwrites its own folder, a
compaction that is repeated overwrites the base that doesn't count. Files
are bounded by ``2 * every`` recent folders, two bases and two manifests,
whatever the number of batches. A base is rewritten once in ``every``
batches, so its cost a batch is its size over ``every``.

Readers keep a valid view for ``every`` batches. The folder belongs to one
checkpoint, as with the ``table`` sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripflow.session import scratch_path
from tripflow.sources.paths import exists
from tripflow.streaming.runner import (
    BATCH_COL,
    _claim,
    _latest_per_key,
    _starting,
    _trigger,
    count_progress,
    finish,
)

MANIFEST = "version long, base int, upto long"


def _manifest(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Version, base folder and last batch of the base; -1 each before the first compaction."""
    slots = [p for p in (f"{path}/manifest/slot={k}" for k in (0, 1)) if exists(spark, p)]
    rows = spark.read.schema(MANIFEST).parquet(*slots).collect() if slots else []  # one row each
    return tuple(max(rows, key=lambda r: r["version"])) if rows else (-1, -1, -1)


def _level(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None) -> DataFrame:
    numbered = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.LongType())])
    if not exists(spark, path):
        return spark.createDataFrame([], numbered)
    found = spark.read.schema(numbered).parquet(path)
    return found.drop(partition) if partition else found


def _versions(spark: SparkSession, path: str, schema: T.StructType, base: int, upto: int) -> DataFrame:
    """The base that counts, and all versions of the batches after it."""
    recent = _level(spark, f"{path}/recent", schema, "slot").filter(F.col(BATCH_COL) > upto)
    return recent if base < 0 else recent.unionByName(_level(spark, f"{path}/base/slot={base}", schema))


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], upto: int) -> bool:
    """Merge all batches up to ``upto`` into a new base; False if the base has them already."""
    version, base, done = _manifest(spark, path)
    if done >= upto:
        return False
    merged = _latest_per_key(
        _versions(spark, path, schema, base, done).filter(F.col(BATCH_COL) <= upto), keys
    ).withColumn(BATCH_COL, F.lit(upto).cast("long"))
    new = 1 - base if base >= 0 else 0
    merged.write.mode("overwrite").parquet(f"{path}/base/slot={new}")
    row = spark.createDataFrame([(version + 1, new, upto)], MANIFEST).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/manifest/slot={(version + 1) % 2}")
    return True


def batch_writer(path: str, schema: T.StructType, keys: list[str], every: int, checkpoint: str | None = None):
    """A ``foreachBatch`` function; with ``checkpoint`` the folder is claimed for that query."""
    if every < 1:
        raise ValueError("every must be 1 at least")
    path, claimed = path.rstrip("/"), []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if checkpoint and not claimed:
            _claim(spark, path, checkpoint.rstrip("/"))
            claimed.append(True)
        if batch_id >= 2 * every and _manifest(spark, path)[2] < batch_id - 2 * every:
            raise RuntimeError(f"batch {batch_id - 2 * every} of {path} is not in its base yet")
        numbered = batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{path}/recent/slot={batch_id % (2 * every)}")
        if (batch_id + 1) % every == 0:
            compact(spark, path, schema, keys, batch_id)

    return write


def read_compacted(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest version of every key."""
    path = path.rstrip("/")
    _, base, upto = _manifest(spark, path)
    return _latest_per_key(_versions(spark, path, schema, base, upto), keys)


def start_compacted(
    df: DataFrame,
    path: str,
    keys: list[str],
    every: int = 8,
    checkpoint: str | None = None,
    name: str | None = None,
    trigger: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start an update-mode query whose answer is kept under ``path``; returns at once."""
    spark = df.sparkSession
    count_progress(spark)
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name or 'compacted'}")
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = _trigger(writer.foreachBatch(batch_writer(path, df.schema, keys, every, checkpoint)), trigger)
    if state_partitions is None:
        return writer.start()
    with _starting:
        previous = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return writer.start()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", previous)


def run_compacted(df: DataFrame, name: str, keys: list[str], every: int = 8, timeout: float | None = None, **settings) -> DataFrame:
    """Run over all data available now and return the answer."""
    spark = df.sparkSession
    path = settings.pop("path", None) or scratch_path(spark, f"out-{name}")
    finish(start_compacted(df, path, keys, every, trigger="availableNow", **settings), timeout, name)
    return read_compacted(spark, path, df.schema, keys)
