"""Centroid clustering of integer vectors with a LAESA pivot table.

Each vector's squared distances to a few fixed pivots are computed and
stored once, next to the vector. In every round the driver has the
centroids' distances to the pivots; by the triangle inequality the
difference of two pivot distances bounds the distance of vector and
centroid from below. A vector's exact integer distance to the centroid of
the least bound comes first; only centroids whose bound does not exceed it
get an exact distance too. A bound never discards a tie, so the result
equals that of a full comparison.

A round is one scan of the stored table; a task sends one row a centroid
(count and sums), which Spark adds up. The driver holds ``k`` centroids and
the pivots, nothing that grows with the data.

The pivots come from a bounded sample, the ``PIVOT_SAMPLE`` kept vectors of
smallest hash, each chosen for the largest sum of distances to those before.
They decide how much is skipped, not the result.

Defined results: rows whose vector is null, has another number of
components than ``dims``, or holds a null or non-finite component are left
out; components beyond ``2^26 / scale`` count as that. Repeated rows are
vectors of their own, each counted; equal hashes are ordered by the
vector. A null id hashes as empty text. With fewer vectors than ``k``
there are as many centroids as vectors; an empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import settle
from tripflow.llm.vectors import finite, group_sums, matrix, scaled
from tripflow.llm.worker import lean

PIVOTS, PIVOT_SAMPLE = 8, 64
# Relative slack that covers the rounding of square roots.
SLACK = 1e-9


def squared(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one vector."""
    apart = rows - one
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Vectors of the sample, each with the largest sum of distances to those chosen before."""
    if len(sample) == 0:
        return sample
    chosen, far = [0], np.zeros(len(sample))
    while len(chosen) < min(most, len(sample)):
        far = far + np.sqrt(squared(sample, sample[chosen[-1]]))
        far[chosen] = -1
        chosen.append(int(far.argmax()))
    return sample[chosen]


def nearest(rows: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """Nearest centroid of each row, its squared distance, and the number of exact distances taken.

    ``to_pivots`` has the rows' squared distances to the pivots.
    """
    n, k = len(rows), len(centroids)
    mine = np.sqrt(to_pivots.astype(np.float64))
    theirs = np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1).astype(np.float64))
    bound = np.zeros((n, k))
    for p in range(len(pivots)):
        a, b = mine[:, p, None], theirs[None, :, p]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    first = bound.argmin(axis=1)
    best = np.empty(n, dtype=np.int64)
    for c in range(k):
        at = np.flatnonzero(first == c)
        best[at] = squared(rows[at], centroids[c])
    label, taken = first.copy(), n
    reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    for c in range(k):
        at = np.flatnonzero((bound[:, c] <= reach) & (first != c))
        if len(at):
            taken += len(at)
            d = squared(rows[at], centroids[c])
            nearer = (d < best[at]) | ((d == best[at]) & (c < label[at]))
            best[at[nearer]], label[at[nearer]] = d[nearer], c
            reach[at] = np.sqrt(best[at].astype(np.float64)) * (1 + SLACK)
    return label, best, taken


def _with_pivot_distances(dims: int, pivots: np.ndarray):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1), dims)
            table = np.stack([squared(rows, p) for p in pivots], axis=1)
            flat = pa.array(table.ravel(), pa.int64())
            ends = pa.array(np.arange(0, table.size + 1, len(pivots), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, flat)], names=["id", "v", "pd"]
            )

    return run


def _sums(dims: int, centroids: np.ndarray, pivots: np.ndarray):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), dims)
            label, _, _ = nearest(rows, matrix(batch.column(1), len(pivots)), centroids, pivots)
            n, s = group_sums(label, rows, k)
            count, total = count + n, total + s
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int32()),
                pa.array(count[full], pa.int64()),
                pa.array(total[full].tolist(), pa.list_(pa.int64())),
            ],
            names=["c", "n", "sums"],
        )

    return run


def _labels(centroids: np.ndarray, pivots: np.ndarray, dims: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, best, _ = nearest(
                matrix(batch.column(1), dims), matrix(batch.column(2), len(pivots)), centroids, pivots
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(label, pa.int32()), pa.array(best, pa.int64())],
                names=["id", "cluster", "distance"],
            )

    return run


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_size, cluster_inertia, inertia, centroid (list of long).

    Components become ``floor(scale * x)``; distances are squared and exact.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    kept = vectors.filter(finite(v) & (F.size(v) == dims)).select(F.col(id_col).alias("id"), scaled(v, scale).alias("v"))
    seed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    sample = [r["v"] for r in kept.orderBy(seed, "v").limit(max(k, PIVOT_SAMPLE)).collect()]
    schema = f"id {dict(kept.dtypes)['id']}, cluster int, distance long"
    out = "id", "cluster", "distance", "cluster_size", "cluster_inertia", "inertia", "centroid"
    if not sample:
        types = "cluster_size long, cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], f"{schema}, {types}").select(F.col("id").alias(id_col), *out[1:])
    sample = np.array(sample, dtype=np.int64)
    centroids, pivots = sample[:k].copy(), choose_pivots(sample)
    stored = settle(
        kept.mapInArrow(_with_pivot_distances(dims, pivots), f"{schema.split(',')[0]}, v array<int>, pd array<long>"),
        "centroid-vectors",
    )
    for _ in range(rounds):
        sums = (
            stored.select("v", "pd")
            .mapInArrow(_sums(dims, centroids, pivots), "c int, n long, sums array<long>")
            .groupBy("c")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)])
        )
        for r in sums.collect():  # k rows at most
            centroids[r["c"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dims)]
    found = settle(stored.mapInArrow(_labels(centroids, pivots, dims), schema), "centroid-labels")
    sizes = found.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("cluster_size"), F.sum("distance").alias("cluster_inertia")
    ).collect()  # k rows at most
    every = sum(r["cluster_inertia"] for r in sizes)
    facts = spark.createDataFrame(
        [(r["cluster"], r["cluster_size"], r["cluster_inertia"], every, centroids[r["cluster"]].tolist()) for r in sizes],
        "cluster int, cluster_size long, cluster_inertia long, inertia long, centroid array<long>",
    )
    return found.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), *out[1:])
