"""Consistent-hash ring with virtual nodes and bounded loads.

The ring has ``POINTS`` points. Every shard stands on ``vnodes`` of them
(virtual nodes); a key falls on the point its hash names and belongs to the
next virtual node clockwise. No shard takes more than its bound: keys of a
full shard continue clockwise to the next shard that has room. With the
default bounds (``load=None``) the capacities are the row count divided by
the shards, one more for the first of the remainder, so all shards are
filled exactly and their counts differ by one at most. With ``load`` 1.25,
say, each shard takes up to 1.25 times the mean and fewer keys move.

Work on the rows is one scan, a count by (point, lane), and a rank within
each (point, lane); the lane is a second hash, so a point with many rows is
ranked by many tasks. The counts (``POINTS * lanes`` numbers at most,
whatever the size of the table) meet on the driver, which walks the ring in
at most ``shards`` hops and gives each arc its pieces: how many of the arc's
rows, in rank order, go to which shard from which slot on. Rows pick their
piece by a broadcast join with that table (``shards * vnodes`` arcs).

Defined results: a null text counts as no bytes and CRC 0; rows with a null
id fall on one point and are told apart by their text; fully repeated rows
take successive slots. An empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import crc32_of, settle

POINTS = 4096


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """The virtual nodes as (point, shard), in ring order; one to a point.

    Points come from a fixed mixing of (shard, node); a taken point passes
    the node on to the next free one, in shard order, so one more shard
    leaves the nodes of the others where they are.
    """
    if shards * vnodes > POINTS // 2:
        raise ValueError(f"shards * vnodes must not exceed {POINTS // 2}")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(vnodes):
            x = (shard * 0x9E3779B97F4A7C15 + (node + 1) * 0xC2B2AE3D27D4EB4F) % 2**64
            x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) % 2**64
            point = (x >> 40) % POINTS
            while point in taken:
                point = (point + 1) % POINTS
            taken[point] = shard
    return sorted(taken.items())


def capacities(total: int, shards: int, load: float | None) -> list[int]:
    """The most rows of each shard; their sum is ``total`` at least."""
    if load is None:
        return [total // shards + (s < total % shards) for s in range(shards)]
    if load < 1:
        raise ValueError("load must be 1 at least")
    return [int(-(-total * load // shards))] * shards


def walk(arcs: list[int], owners: list[int], room: list[int]) -> list[list[tuple[int, int, int]]]:
    """Pieces (end rank, shard, first slot) of each arc, in rank order.

    ``arcs`` has each arc's rows, ``owners`` the shard at its end. Hop by
    hop, rows that found no room look at the next shard clockwise that they
    have not seen; within a hop, arcs are served in ring order.
    """
    shards, n = len(room), len(arcs)
    routes = []
    for a in range(n):
        seen: dict[int, None] = {}
        for k in range(n):
            seen.setdefault(owners[(a + k) % n])
            if len(seen) == shards:
                break
        routes.append(list(seen))
    left, used = list(arcs), [0] * shards
    pieces: list[list[tuple[int, int, int]]] = [[] for _ in arcs]
    for hop in range(shards):
        for a in range(n):
            shard = routes[a][hop] if hop < len(routes[a]) else None
            take = min(left[a], room[shard] - used[shard]) if shard is not None else 0
            if take > 0:
                left[a] -= take
                pieces[a].append((arcs[a] - left[a], shard, used[shard]))
                used[shard] += take
    if any(left):
        raise ValueError("the capacities are less than the rows")
    return pieces


def shard_rows(
    docs: DataFrame,
    shards: int = 24,
    vnodes: int = 64,
    load: float | None = None,
    lanes: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot.

    Slots are gapless from 0 within each shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        crc32_of(text).alias("text_crc32"),
    )
    key = F.xxhash64("doc_id")
    rows = settle(
        rows.withColumn("point", F.pmod(key, F.lit(POINTS)).cast("int")).withColumn(
            "lane", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(lanes)).cast("int")
        ),
        "sharding",
    )
    counts = rows.groupBy("point", "lane").agg(F.count(F.lit(1)).alias("n"))
    counted = sorted(tuple(r) for r in counts.collect())  # POINTS * lanes rows at most

    nodes = ring(shards, vnodes)
    ends, owners = [p for p, _ in nodes], [s for _, s in nodes]
    # a point belongs to the first virtual node at or after it, the last ones to the first node
    arc_of = [bisect_left(ends, p) % len(ends) for p in range(POINTS)]
    arcs, starts = [0] * len(ends), []
    for point, lane, n in counted:
        starts.append((point, lane, arc_of[point], arcs[arc_of[point]]))
        arcs[arc_of[point]] += n
    pieces = walk(arcs, owners, capacities(sum(arcs), shards, load))
    at = spark.createDataFrame(
        [(p, lane, start, pieces[a]) for p, lane, a, start in starts],
        "point int, lane int, start long, pieces array<struct<end: long, shard: int, slot: long>>",
    )
    ranked = rows.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("point", "lane").orderBy("doc_id", "text_crc32", "size")) - 1,
    ).join(F.broadcast(at), ["point", "lane"])
    rank = F.col("rank") + F.col("start")
    before = F.filter("pieces", lambda p: p["end"] <= rank)
    mine = F.element_at("pieces", F.size(before) + 1)
    first = F.coalesce(F.get(F.col("pieces"), F.size(before) - 1)["end"], F.lit(0).cast("long"))
    return ranked.select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        mine["shard"].alias("shard"),
        (mine["slot"] + rank - first).alias("slot"),
    )


def shard_bytes(assigned: DataFrame) -> DataFrame:
    """Rows and bytes of each shard, of what ``shard_rows`` returned."""
    return assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("size")).alias("bytes")
    )

