"""A publish that can be repeated: each record once, in order within its key.

Records are numbered within their key by pickup (ties by the record's text),
by range partitions, so that a key with a third of all records is numbered
by many tasks. Numbers depend on the records alone, so a repeated publish
gives every record the number that it had. Records go out in chunks of
consecutive numbers of a key; a progress table (``PartTable``) notes each
chunk that is out with a digest of its records, and a publish sends only the
chunks that are missing or differ. Chunks, not records, reach the driver.

To a folder, chunks are the table's parts: a chunk is visible whole and once.
To a topic, a chunk is noted after it was sent; one that was sent and not
noted (the job died between) is sent again, and readers drop it by the
record's key and ``number`` header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.ranking import global_rank
from tripflow.operators.wire import encode_rides
from tripflow.schemas import ServiceSpec, service
from tripflow.sinks.parts import PartTable

RECORD = "key string, value string, number long"


def numbered_records(trips: DataFrame, spec: ServiceSpec | str) -> DataFrame:
    """Rows (key, value, number); numbers start at 0 in each key and follow the pickup, then the text."""
    spec = service(spec)
    order = [F.col("key"), F.col(spec.pickup_col), F.col("value")]
    ranked = global_rank(encode_rides(trips, spec, keep=[spec.pickup_col]), order, "rank")
    first = ranked.groupBy("key").agg(F.min("rank").alias("first"))  # a row a vendor
    return ranked.join(F.broadcast(first), "key").select("key", "value", (F.col("rank") - F.col("first")).alias("number"))


def _chunked(records: DataFrame, chunk_rows: int) -> DataFrame:
    name = F.regexp_replace("key", "[^A-Za-z0-9_-]", "_")
    chunk = F.lpad(F.floor(F.col("number") / chunk_rows).cast("string"), 12, "0")
    return records.withColumn("part", F.concat(name, F.lit("."), F.substring(F.sha2("key", 256), 1, 8), F.lit("."), chunk))


def publish_once(
    spark: SparkSession, trips: DataFrame, spec: ServiceSpec | str, progress: str, chunk_rows: int = 1_000_000, send=None
) -> list[str]:
    """Publish what is not out yet; returns the names of the chunks that went out.

    Without ``send`` the records themselves lie under ``progress`` (``published`` reads
    them). ``send`` takes a DataFrame of records (key, value, number) and writes it, to a
    topic say; then ``progress`` holds the digests only.
    """
    chunked = _chunked(numbered_records(trips, spec), chunk_rows)
    # a sum of hashes: the digest doesn't depend on the order of rows
    digest = F.concat_ws(":", F.count(F.lit(1)), F.sum(F.xxhash64("key", "value", "number").cast("decimal(38,0)")))
    table = PartTable(spark, progress)
    digests = {r["part"]: r["digest"] for r in chunked.groupBy("part").agg(digest.alias("digest")).collect()}
    out = table.live()
    missing = {p: d for p, d in digests.items() if out.get(p) != d}
    gone = dict.fromkeys(p for p in out if p not in digests)
    if not missing and not gone:
        return []
    names = spark.createDataFrame([(p,) for p in missing], "part string")
    todo = chunked.join(F.broadcast(names), "part", "left_semi").select("part", "key", "value", "number")
    if send is None:
        table.replace(todo, missing | gone)
    else:
        send(todo.select("key", "value", "number"))
        table.replace(todo.limit(0), missing | gone)
    return sorted(missing)


def published(spark: SparkSession, progress: str) -> DataFrame:
    """The records (key, value, number) that are out."""
    return PartTable(spark, progress).read(RECORD).drop("part")
