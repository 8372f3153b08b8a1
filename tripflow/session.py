"""Session factory and shared-folder helpers.

Every job in this package runs with the session time zone set to UTC and
ANSI SQL on. Raw and wire data are parsed with ``try_cast`` / ``get`` so
that malformed input becomes null instead of failing the job; everything
else keeps ANSI's fail-fast arithmetic.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that hold on any cluster size. Shuffle partitions are a default
# for local runs; on a cluster AQE coalesces and splits from this start.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.groupByOrdinal": "true",
    # rows written per file stay bounded however large a month is
    "spark.sql.files.maxRecordsPerFile": "5000000",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


# Added on a cluster master (not local): scan splits and AQE's target
# partition size of 256 MB keep task counts in the hundreds of thousands at
# 100 TB instead of near a million; coalescing follows size, not the number
# of cores; the initial shuffle width leaves AQE room to split a hot key
# group and merge the rest.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "2000",
}


def get_session(
    master: str | None = None,
    app_name: str = "tripflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session with the package defaults, or reuse the active one.

    ``master`` is only set when given, so that ``spark-submit`` decides on a
    cluster. ``shuffle_partitions`` defaults to 8 on a local master (tests,
    bench); elsewhere ``CLUSTER_CONF`` applies. An already active session is
    returned with only the runtime SQL defaults applied: its own sizing
    (shuffle partitions, split sizes) is left as its owner set it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_sql_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        conf.setdefault("spark.driver.memory", os.environ.get("TRIPFLOW_DRIVER_MEMORY", "8g"))
    else:
        conf.update(CLUSTER_CONF)
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings on a session built elsewhere."""
    for key, value in BASE_CONF.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor and the driver
    can reach). Only a local session without one gets a fresh folder of
    its own, as in tests.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - session without a SparkContext (Spark Connect)
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder") from None
        return root
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_root = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_root:
        sc.setCheckpointDir(conf_root)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder of the cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripflow-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/tripflow/{name}-{uuid.uuid4().hex[:12]}"


# Bytes of an Arrow batch that a Python worker gets at once (Spark's own limit
# is 64 MB): long texts then arrive in small parts, and neither the executor
# nor its workers hold a whole partition.
ARROW_BATCH_BYTES = 8 << 20

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Sends the package's source files once per application; jobs that run
    Python in tasks call it, so that nothing has to be installed on the
    executors. Arrow batches of the session are kept small.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tripflow-ship-")) / "tripflow.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
