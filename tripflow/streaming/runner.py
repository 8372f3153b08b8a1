"""Start, sink, wait for and inspect streaming queries.

Sinks:

* ``console`` and ``memory`` (debugging, small results);
* ``parquet`` - Spark's file sink, append mode only (stateless queries or
  watermarked aggregations), exactly once through its checkpoint;
* ``table`` - any output mode through ``foreachBatch``. Each micro-batch runs
  its plan and overwrites its own folder, so a batch that is replayed after
  a failure replaces its output and commits its state like any other.
  Append and update modes keep one ``batch_n=N`` folder a batch; complete
  mode alternates between two folders, as only the last answer counts.
  ``read_table_sink`` turns the folder into the query's answer: all rows
  (append), the last batch (complete) or the last version of every key
  (update), all as Spark jobs. Update mode's folder grows by one version of
  each changed key a batch.

A ``table`` folder belongs to the query (the id in the checkpoint) that
wrote it first; a query with another checkpoint is refused before it writes,
since its batch numbers would collide. Give ``checkpoint`` to resume a query
after a restart; without one, a start is a new query with a new folder under
the session's shared checkpoint folder.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tripflow.session import scratch_path
from tripflow.sources.paths import exists

BATCH_COL = "batch_id"
# Beside a table folder, the id of its query.
OWNER = ".owner"
# The shuffle setting is the session's; starts that change it go one by one.
_starting = threading.Lock()


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "default":
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def _not_there(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Make sure that the table folder is this query's, or nobody's yet."""
    mine = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    owner = spark.read.text(f"{path}{OWNER}").first() if exists(spark, f"{path}{OWNER}") else None
    if owner is None:
        spark.range(1).select(F.lit(mine).alias("value")).write.mode("overwrite").text(f"{path}{OWNER}")
    elif owner[0] != mine:
        raise RuntimeError(f"{path} holds the output of another query ({owner[0]}); give its checkpoint or a new folder")


def _table_batch_writer(path: str, mode: str, checkpoint: str):
    base, claimed = path.rstrip("/"), []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not claimed:
            _claim(batch.sparkSession, base, checkpoint.rstrip("/"))
            claimed.append(True)
        numbered = batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        folder = f"batch_slot={batch_id % 2}" if mode == "complete" else f"batch_n={batch_id}"
        numbered.write.mode("overwrite").parquet(f"{base}/{folder}")

    return write


def start_query(
    df: DataFrame,
    name: str | None = None,
    mode: str = "update",
    sink: str = "console",
    path: str | None = None,
    checkpoint: str | None = None,
    trigger: str | None = None,
    options: dict[str, str] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start one streaming query; returns at once.

    ``state_partitions`` sets the number of shuffle (state store)
    partitions of a stateful query. It is fixed by the checkpoint at the
    first start; the metrics here pre-aggregate before the state store and
    keep one row per open window (or one row in all), so a few partitions
    hold their state at any input rate.
    """
    spark = df.sparkSession
    count_progress(spark)
    writer = df.writeStream.outputMode(mode)
    if name:
        writer = writer.queryName(name)
    if checkpoint is None and sink not in ("console", "memory"):
        checkpoint = scratch_path(spark, f"ckpt-{name or sink}")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if sink in ("table", "parquet") and not path:
        raise ValueError(f"sink {sink!r} needs a path")
    if sink == "console":
        writer = writer.format("console").option("truncate", "false")
    elif sink == "memory":
        writer = writer.format("memory")
    elif sink == "parquet":
        if mode != "append":
            raise ValueError("the parquet file sink supports append mode only")
        writer = writer.format("parquet").option("path", path)
    elif sink == "table":
        writer = writer.foreachBatch(_table_batch_writer(path, mode, checkpoint))
    elif sink == "kafka":
        writer = writer.format("kafka")
    else:
        raise ValueError(f"unknown sink {sink!r}")
    if state_partitions is None:
        return _trigger(writer, trigger).start()
    with _starting:
        previous = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return _trigger(writer, trigger).start()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", previous)


def finish(query: StreamingQuery, timeout: float | None = None, name: str | None = None) -> None:
    """Wait until a query has ended; raise its failure, or TimeoutError when a given limit passes first.

    The query goes on after a TimeoutError; without a limit it may run as
    long as it needs.
    """
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"query {name or query.name} failed: {query.exception()}")
    if timeout is not None and not ended:
        raise TimeoutError(f"query {name or query.name} did not end in {timeout} s")


def await_all(queries, timeout: float | None = None) -> None:
    """Wait for every query; raise the first failure, or TimeoutError."""
    end = None if timeout is None else time.monotonic() + timeout
    for q in list(queries.values() if isinstance(queries, dict) else queries):
        finish(q, None if end is None else max(0.001, end - time.monotonic()))


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Wait until any query has ended; raise its failure, or TimeoutError when a given limit passes first."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    elif not spark.streams.awaitAnyTermination(timeout):
        raise TimeoutError(f"no query ended in {timeout} s")


def _latest_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    cols = [c for c in df.columns if c not in (BATCH_COL, "batch_n", "batch_slot")]
    values = [c for c in cols if c not in keys]
    latest = F.max_by(F.struct(*[F.col(c) for c in values]), F.col(BATCH_COL)).alias("__v")
    grouped = df.groupBy(*keys).agg(latest) if keys else df.agg(latest)
    return grouped.filter(F.col("__v").isNotNull()).select(*keys, "__v.*").select(*cols)


def read_table_sink(
    spark: SparkSession,
    path: str,
    mode: str,
    keys: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The answer held by a ``table`` sink folder (see module doc).
    ``schema`` (the query's output schema) answers an empty result when no
    batch has been written yet."""
    try:
        out = spark.read.parquet(path)
    except AnalysisException as e:
        if schema is None or not _not_there(e):
            raise
        return spark.createDataFrame([], schema)
    cols = [c for c in out.columns if c not in (BATCH_COL, "batch_n", "batch_slot")]
    if mode == "append":
        return out.select(*cols)
    if mode == "complete":
        last = out.agg(F.max(BATCH_COL).alias("__last"))
        return out.join(F.broadcast(last), out[BATCH_COL] == last["__last"]).select(*cols)
    if mode == "update":
        return _latest_per_key(out, keys or [])
    raise ValueError(f"unknown output mode {mode!r}")


def run_to_table(
    df: DataFrame,
    mode: str,
    name: str,
    keys: list[str] | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
    timeout: float | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Run a streaming query over all data available now into a ``table``
    sink and return its answer as a DataFrame."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"out-{name}")
    q = start_query(
        df,
        mode=mode,
        sink="table",
        path=path,
        checkpoint=checkpoint,
        trigger="availableNow",
        state_partitions=state_partitions,
    )
    finish(q, timeout, name)
    return read_table_sink(spark, path, mode, keys, schema=df.schema)


def run_to_parquet(
    df: DataFrame,
    name: str,
    path: str | None = None,
    checkpoint: str | None = None,
    timeout: float | None = None,
) -> tuple[str, str]:
    """Run an append-mode query over all available data into Spark's
    parquet file sink; returns (path, checkpoint) for reruns."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"files-{name}")
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-{name}")
    q = start_query(
        df, mode="append", sink="parquet", path=path, checkpoint=checkpoint, trigger="availableNow"
    )
    finish(q, timeout, name)
    return path, checkpoint


class _Progress(StreamingQueryListener):
    """Input rows, late rows and batches of every run, and which runs have ended."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.late: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.late[run] = self.late.get(run, 0) + dropped
        self.batches[run] = self.batches.get(run, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


_progress: dict[str, _Progress] = {}


def count_progress(spark: SparkSession) -> _Progress:
    """The session's progress counter; queries started before its first call are not counted."""
    app = spark.conf.get("spark.app.id", "")
    if app not in _progress:
        _progress[app] = _Progress()
        spark.streams.addListener(_progress[app])
    return _progress[app]


def query_status(spark: SparkSession, queries=None) -> DataFrame:
    """Name, id, activity and input volume of streaming queries (the active
    ones by default) as a small DataFrame, counted over all their batches.

    ``late_rows`` is what the state operators dropped behind the watermark. An
    aggregation drops partial aggregates, one for each task and late window, so
    it counts those; ``fanout.fanout_status`` counts late rides one by one.
    """
    qs = list(queries.values() if isinstance(queries, dict) else queries) if queries else spark.streams.active
    counted = count_progress(spark)
    end = time.monotonic() + 30
    while time.monotonic() < end and any(not q.isActive and str(q.runId) not in counted.ended for q in qs):
        time.sleep(0.05)  # events reach a listener after the query has moved on
    rows = []
    for q in qs:
        run = str(q.runId)
        if not q.isActive and run not in counted.ended:
            raise RuntimeError(f"the last events of query {q.name} have not arrived")
        message = str(q.status.get("message", ""))
        rows.append(
            (
                q.name,
                str(q.id),
                bool(q.isActive),
                message,
                counted.rows.get(run, 0),
                counted.batches.get(run, 0),
                counted.late.get(run, 0),
            )
        )
    schema = "name string, id string, is_active boolean, message string, input_rows long, batches int, late_rows long"
    return spark.createDataFrame(rows, schema)
