"""Helpers shared by the text operators: table reads, settled results, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.bitmaps import MAX_BITS, bit_set, position, with_test
from tripflow.session import scratch_path

# Fixed value: the white space that the contracts name, as a Java and RE2 class.
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage and survives the loss of executors; it is
    written once however often it is read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Stands for a null id; smaller than all others.
NO_ID = -(2**63)


def keyed_rows(docs: DataFrame, id_col: str, text_col: str, *keep: Column) -> DataFrame:
    """Rows (id, tie, text, *keep): ``id`` is a long, ``NO_ID`` for null; id and ``tie`` together name a document.

    ``tie`` is 0 for an id that only one row has, else a hash of the text: rows
    of one id (or none) with different texts are documents of their own, in the
    order of that hash; fully repeated rows are the same document.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = docs.select(key.alias("id"), F.col(text_col).alias("text"), *keep)
    again = settle(rows.groupBy("id").count().filter("count > 1").select("id"), "repeated-ids")
    bits = power_of_two(16 * again.count(), 1 << 16, MAX_BITS)
    some = settle(bit_set(again.select(position(F.col("id"), bits).alias("p")), "p"), "repeated-id-bits")
    tested = with_test(rows.withColumn("_p", position(F.col("id"), bits)), "_p", some, "_again")
    tie = F.when(F.col("_again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return tested.select("id", tie.alias("tie"), *rows.columns[1:])


def crc32_of(value: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text of ``value``."""
    return F.crc32(value.cast("string").cast("binary"))


def power_of_two(n: int, low: int, high: int) -> int:
    """The least power of two from ``n`` up, kept between ``low`` and ``high``."""
    return max(low, min(high, 1 << max(0, int(n - 1).bit_length())))


def vocabulary_path() -> str:
    """Place of the vocabulary file that the queries and the pipeline encode with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
