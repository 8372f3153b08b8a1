"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 reads the texts once and keeps a narrow row for each document: its
id, the SHA-256 of its normalised text and its length. Each hash sets one
position in each of two bit arrays; positions that two rows set form a
Bloom filter of bounded size. Pass 2 tests every narrow row against the
broadcast filter: a row of which one position was set only by itself has no
equal and passes straight through. Only the others are shuffled, grouped by
their hash (with partial aggregation) and joined back.

Groups with more than 1/512 of the rows (so 511 at most) are joined by
broadcast, so that a text held by a third of all rows is never gathered in
one task.

Defined results: a null text counts as empty; empty texts equal each other;
texts that differ only in white space are equal. Of equal texts the row
with the most code points stays, then the one with the smallest id (a null
id first), then any one of fully repeated rows, so each group keeps exactly
one row. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bitmaps import MAX_BITS, bit_set, position, with_test
from tripflow.llm.common import SPACE, power_of_two, settle

# A group above rows / HOT_SHARE rows is joined by broadcast.
HOT_SHARE = 512


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS // 2
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``max_bits`` bounds each of the filter's two bit arrays (the broadcast
    is at most ``2 * max_bits / 8`` bytes); beyond it more rows are
    shuffled, with the same result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.regexp_replace(text, f"{SPACE}+", "")
    narrow = settle(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(bare.cast("binary"), 256)).alias("sha"),
            F.char_length(text).alias("points"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-dedup",
    )
    rows = narrow.count()
    bits = power_of_two(16 * rows, 1 << 16, max_bits)
    placed = narrow.withColumn("p0", position(F.col("sha"), bits, 0)).withColumn(
        "p1", position(F.col("sha"), bits, 1) + bits
    )
    # pass 1: the positions that more than one row sets
    twice = (
        placed.select(F.explode(F.array("p0", "p1")).alias("p"))
        .groupBy("p")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    bloom = settle(bit_set(twice, "p"), "exact-dedup-bloom")
    # pass 2: rows that may have an equal, and the rest
    tested = with_test(with_test(placed, "p0", bloom, "t0"), "p1", bloom, "t1")
    maybe = tested.filter(F.col("t0") & F.col("t1")).select("doc_id", "sha", "points", "row")
    alone = tested.filter(~(F.col("t0") & F.col("t1"))).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    groups = settle(
        maybe.groupBy("sha").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct((-F.col("points")).alias("less"), "doc_id", "row")).alias("best"),
        ),
        "exact-dedup-groups",
    )
    most = max(1, rows // HOT_SHARE)
    hot, cold = groups.filter(F.col("group_size") > most), groups.filter(F.col("group_size") <= most)
    joined = maybe.join(F.broadcast(hot), "sha", "left")
    found = joined.filter("best IS NOT NULL").unionByName(
        joined.filter("best IS NULL").select(maybe.columns).join(cold, "sha")
    )
    grouped = found.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        "sha",
    )
    out = alone.unionByName(grouped)
    return out.select(
        F.col("doc_id").alias(id_col),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay; ids must be unique and not null."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(id_col)
    return docs.join(kept, id_col, "left_semi")
