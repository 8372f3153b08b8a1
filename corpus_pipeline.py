"""A corpus pipeline over ``documents``: five stages, each on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the
columns of ``documents``; the last one adds the encoding.

1. ``language_id`` drops documents without a letter and those that resemble
   no language (very short ones can't be judged and stay); profiles are
   learned from the documents' own ``lang``.
2. ``line_dedup`` removes every line of a word or more that resembles an
   earlier one (Jaccard 0.8 of word sets) and drops documents that have no
   word left thereby.
3. ``ngram_dedup`` keeps one document (the smallest id) of each group linked
   by a Jaccard similarity of 0.8 or more of 5-word shingles.
4. ``decontamination`` drops documents with a benchmark passage (word edit
   distance up to a fifth of its length).
5. ``bpe`` encodes the texts, decodes the ids, and reports both.

Defined results: null and empty texts have no letter and go in the first
stage; repeated rows leave one; an empty table passes through all stages;
further columns of ``documents`` are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.bpe import encode_texts
from tripflow.llm.common import SPACE, documents, settle, vocabulary_path
from tripflow.llm.decontaminate import clean_documents
from tripflow.llm.language_id import accepted
from tripflow.llm.line_dedup import cleaned_rows
from tripflow.llm.ngram_join import one_of_each_group
from tripflow.session import ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    left = F.regexp_replace("kept_text", f"{SPACE}+", "") != ""
    cleaned = cleaned_rows(docs, min_words=1, keep=tuple(c for c in docs.columns if c != "text"))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cleaned.filter((F.col("n_removed") == 0) | left).select(
        *(new.get(c, F.col("kept")[c]).alias(c) for c in docs.columns)
    )


def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_of_each_group(docs, size=5, num=8, den=10)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    coded = encode_texts(docs, vocabulary_path(), keep=(F.struct(*docs.columns).alias("row"),), decoded=True)
    row = [(F.col("decoded") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    return coded.select(*row, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_dedup", ngram_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# SQL has neither the bundles of stage 1 nor the merges of stage 5; tests hold the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
