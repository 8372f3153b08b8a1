"""Stream sources for rides: a Kafka topic, or files for tests and replays."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class KafkaSource:
    """Options of a Kafka subscription.

    ``security`` takes ``"SASL_SSL"`` with ``mechanism`` (e.g. OAUTHBEARER)
    and ``token_endpoint``; everything in ``extra`` is passed through as
    ``kafka.*`` options. ``max_offsets_per_trigger`` bounds a micro-batch
    (a restart after a long stop does not read the whole backlog at once);
    ``min_partitions`` gives a batch more tasks than the topic has
    partitions.
    """

    bootstrap_servers: str
    topic: str
    starting_offsets: str = "earliest"
    security: str | None = None
    mechanism: str | None = None
    token_endpoint: str | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True
    extra: dict[str, str] = field(default_factory=dict)


def kafka_options(src: KafkaSource) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": src.bootstrap_servers,
        "subscribe": src.topic,
        "startingOffsets": src.starting_offsets,
        # stop rather than skip records the topic no longer holds
        "failOnDataLoss": "true" if src.fail_on_data_loss else "false",
    }
    if src.security:
        opts["kafka.security.protocol"] = src.security
    if src.mechanism:
        opts["kafka.sasl.mechanism"] = src.mechanism
    if src.token_endpoint:
        opts["kafka.sasl.oauthbearer.token.endpoint.url"] = src.token_endpoint
    if src.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(src.max_offsets_per_trigger)
    if src.min_partitions:
        # split large offset ranges into more tasks than topic partitions
        opts["minPartitions"] = str(src.min_partitions)
    for k, v in src.extra.items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = v
    return opts


def kafka_stream(spark: SparkSession, src: KafkaSource) -> DataFrame:
    """Kafka records (needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(src).items():
        reader = reader.option(k, v)
    return reader.load()


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob_filter: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New parquet files under ``path`` as a stream (files are picked up in
    modification order; each file is read once per checkpoint)."""
    reader = spark.readStream.schema(schema)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new text files as a ``value`` column (one ride per line)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``) as a file stream."""
    base = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/{name}.parquet").schema
    return parquet_stream(spark, base, schema, glob_filter=f"{name}.parquet", **kw)


def ride_stream(spark: SparkSession, source: KafkaSource | str, max_per_trigger: int | None = None) -> DataFrame:
    """Wire records as a stream of one ``value`` string column.

    ``source`` is a Kafka subscription, or a folder of text files holding
    one record per line (replays and tests); the caller decodes with
    ``decode_rides``.
    """
    if isinstance(source, KafkaSource):
        src = kafka_stream(spark, source)
        return src.select(src["value"].cast("string").alias("value"))
    return text_stream(spark, source, max_files_per_trigger=max_per_trigger)
