"""Registered queries of the text operators and their DuckDB SQL.

Each ``opN_`` query applies its operator to the whole ``documents`` (or
``conversations``) table and derives the columns its contract names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm import oracle
from tripflow.llm.bpe import encode_texts
from tripflow.llm.centroids import cluster_vectors
from tripflow.llm.chat_format import format_chats
from tripflow.llm.common import crc32_of, documents, vocabulary_path
from tripflow.llm.decontaminate import contaminated
from tripflow.llm.exact_dedup import exact_dedup
from tripflow.llm.grid_codes import compress_vectors
from tripflow.llm.language_id import identify, train_profiles
from tripflow.llm.line_dedup import remove_lines
from tripflow.llm.ngram_join import linked_groups
from tripflow.llm.sharding import shard_rows
from tripflow.llm.simhash import near_groups
from tripflow.llm.substring_dedup import remove_repeats
from tripflow.llm.toxicity import score_toxicity, train_toxicity
from tripflow.session import ship_package

SHARDS = 24


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc32_of(F.col("doc_id")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_toxicity(docs.filter(~held_out), labels.filter(~held_out))
    scored = score_toxicity(docs, model, keep=("doc_id", held_out.alias("held_out")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc32_of(F.col("doc_id")) % 3 == 1
    profiles = train_profiles(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return identify(docs, profiles, keep=["doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out")])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(documents(spark, sf_dir), vocabulary_path(), decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_groups(documents(spark, sf_dir), size=3, num=90, den=100)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(documents(spark, sf_dir), 20)
    return cleaned.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_lines(documents(spark, sf_dir))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.concat_ws(",", F.transform("removed_lines", lambda x: x.cast("string"))).alias("removed_lines"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), parts=4, entries=256, rounds=4)
    printed = ",".join(str(x) for x in books.ravel().tolist())
    digest = hashlib.sha256(printed.encode()).hexdigest()
    return coded.drop("label").withColumn("codebooks_sha256", F.lit(digest))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16, rounds=3, dims=64, scale=64)
    printed = F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string")))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(printed.cast("binary"), 256).alias("centroid_sha256"),
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), size=3).select("doc_id", "fingerprint", "component_id")


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__name__ = getattr(query, "__name__", "query")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_toxicity": op1_toxicity,
        "op2_language_id": op2_language_id,
        "op3_decontamination": op3_decontamination,
        "op4_sharding": op4_sharding,
        "op5_bpe": op5_bpe,
        "op6_ngram_join": op6_ngram_join,
        "op7_chat_format": op7_chat_format,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_vector_codes": op11_vector_codes,
        "op12_centroids": op12_centroids,
        "op13_simhash": op13_simhash,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.ORACLE_SQL
