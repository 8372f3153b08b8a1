"""Batch writers: cleaned months, report, trip details, published rides.

Scale notes:

* Input already clustered by the output partitions (monthly source
  folders: every input split belongs to one month) is written as it is:
  each task writes its own files into its month's folder, no shuffle, and
  file sizes follow the input splits.
* ``cluster=True`` is for input that is not clustered (rows of many
  months mixed in every split): the ``rebalance`` hint shuffles rows by
  the partition columns and AQE cuts them into advisory-size partitions,
  splitting a month that holds a third of all rows over many writers and
  merging small months, instead of every task writing a file into every
  folder.
* ``files=n`` reproduces the original fixed number of files per month
  (``repartition(n)``, round robin, deterministic on retry since Spark
  sorts before it); meant for small months only, as n tasks write the
  whole month.
* ``spark.sql.files.maxRecordsPerFile`` bounds every file.
* Reruns: ``partitionOverwriteMode=dynamic`` replaces only the partitions
  present in the new data, so re-running a month (or a failed job) is
  idempotent; plain append is kept for callers that want it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.wire import encode_rides, kafka_records
from tripflow.schemas import ServiceSpec, service
from tripflow.sources.stream import KafkaSource

# Files per month of the original layout (use with files=...).
ORIGINAL_FILES_PER_MONTH = 4


def _layout(df: DataFrame, files: int | None, partition_cols: list[str] | None, cluster: bool) -> DataFrame:
    if files:
        return df.repartition(files)
    if cluster:
        return df.hint("rebalance", *(partition_cols or []))
    return df


def write_clean(
    df: DataFrame,
    out: str,
    files: int | None = None,
    partition_cols: list[str] | None = None,
    cluster: bool = False,
) -> None:
    """Overwrite cleaned trips.

    Without ``partition_cols``: one folder (a month of the original
    layout). With them: dynamic overwrite of just the partitions present.
    See the module notes for ``files`` and ``cluster``.
    """
    data = _layout(df, files, partition_cols, cluster)
    if not partition_cols:
        data.write.mode("overwrite").parquet(out)
        return
    (
        data.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(out)
    )


def _writer(df: DataFrame, fmt: str, mode: str, partition_cols: list[str] | None, options: dict | None):
    w = df.write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    return w


def write_report(
    df: DataFrame,
    target: str,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    as_table: bool = False,
    options: dict | None = None,
) -> None:
    """Write the report. The default refuses to replace an existing report
    (a rerun stops here); ``mode="overwrite"`` replaces it.

    ``as_table`` saves to the catalog under the name ``target``; otherwise
    ``target`` is a path. ``fmt`` names any installed data source.
    """
    w = _writer(df, fmt, mode, None, options)
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)


# Details are partitioned by service and pickup month, the unit that is
# cleaned and rerun.
DETAILS_PARTITIONS = ["service_type", "year", "month"]


def details_partitions(trips: DataFrame) -> DataFrame:
    """Add the pickup ``year`` and ``month`` as partition columns."""
    return trips.withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})


def write_details(
    trips: DataFrame,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    as_table: bool = False,
    cluster: bool = False,
    options: dict | None = None,
) -> None:
    """Write unified trips to the details table; ``options`` go to the writer.

    ``mode="append"`` adds every row again on a rerun (the original
    behaviour). ``mode="replace"`` overwrites just the (service, month)
    partitions present in ``trips``: running twice leaves one copy.
    """
    parts = DETAILS_PARTITIONS
    data = _layout(details_partitions(trips), None, parts, cluster)
    if mode == "append":
        w = _writer(data, fmt, "append", parts, options)
    elif mode == "replace":
        w = _writer(data, fmt, "overwrite", parts, {"partitionOverwriteMode": "dynamic", **(options or {})})
    else:
        raise ValueError("mode must be 'append' or 'replace'")
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)


def publish_rides(
    trips: DataFrame,
    spec: ServiceSpec | str,
    target: KafkaSource | str,
    fmt: str | None = None,
) -> None:
    """Encode trips and write them from the executors.

    ``target`` is a Kafka topic description (needs the Kafka connector) or
    a path, written as ``fmt`` (json by default) for replays and tests.
    """
    encoded = encode_rides(trips, service(spec))
    if isinstance(target, KafkaSource):
        w = kafka_records(encoded).write.format("kafka")
        w = w.option("kafka.bootstrap.servers", target.bootstrap_servers).option("topic", target.topic)
        if target.security:
            w = w.option("kafka.security.protocol", target.security)
        if target.mechanism:
            w = w.option("kafka.sasl.mechanism", target.mechanism)
        if target.token_endpoint:
            w = w.option("kafka.sasl.oauthbearer.token.endpoint.url", target.token_endpoint)
        for k, v in target.extra.items():
            w = w.option(k if k.startswith("kafka.") else f"kafka.{k}", v)
        w.save()
        return
    encoded.write.mode("append").format(fmt or "json").save(target)
