"""Vector code compression: parts of vectors as codebook indices, found through memoised grid cells.

A vector is cut into equal parts, each coded by the index of the nearest
entry of its position's codebook. A part lies in a cell of a coarse grid
(its components divided by the grid's side). For a cell's box each entry
has a least and a greatest distance; an entry whose least distance exceeds
another's greatest is dominated in the whole box and can't be nearest there.
The entries left are cached under the cell (as a bit mask), and only they
are compared exactly with the parts of that cell. Least and greatest
distances add up over dimensions, so they are sums of table rows.

The grid's side follows from the codebook (a fraction of the usual distance
between entries); it decides how much is skipped, never the result. The
cache of a task holds ``CACHE`` cells a part and round; it is emptied when full.

Codebooks are trained by rounds of assignment and mean, each one scan in
which a task sends one row an entry (count and sums) for Spark to add up.
The driver holds the codebooks alone.

Defined results: rows whose vector is null or holds a null or non-finite
component are left out, as are those whose number of components is not the
table's most frequent one (of equally frequent ones the greatest). Components
beyond ``2^26 / scale`` count as that. Vectors that can't be cut evenly are
filled up with zeros. Repeated rows count each; equal ids are ordered by the
vector, null ids come last. With fewer vectors than entries the codebooks are
shorter; an empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import settle
from tripflow.llm.vectors import finite, group_sums, join_groups, matrix, scaled
from tripflow.llm.worker import lean

CACHE = 1 << 14
# Rows of which the bounds are computed at once.
SLICE = 2048


def grid_side(entries: np.ndarray) -> int:
    """Side of the cells: the usual distance of an entry to the next one, over four half diagonals."""
    if len(entries) < 2 or entries.shape[1] == 0:
        return 1
    least = []
    for k in range(len(entries)):
        d = ((entries - entries[k]) ** 2).sum(axis=1)
        d = d[d > 0]
        if len(d):
            least.append(float(d.min()))
    return max(1, int(np.sqrt(np.median(least) / entries.shape[1]) / 4)) if least else 1


class Cells:
    """Entries that may be nearest in each cell, for one codebook."""

    def __init__(self, entries: np.ndarray, most: int = CACHE):
        self.entries, self.most = entries, most
        self.side = grid_side(entries)
        self.known: dict[bytes, np.ndarray] = {}
        self.asked = self.missed = self.taken = 0

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        """Packed masks of the entries not dominated across each cell's box."""
        low = np.zeros((len(cells), len(self.entries)), dtype=np.int64)
        high = np.zeros_like(low)
        for d in range(cells.shape[1]):
            at, where = np.unique(cells[:, d], return_inverse=True)
            below = self.entries[None, :, d] - at[:, None] * self.side
            above = (at[:, None] + 1) * self.side - 1 - self.entries[None, :, d]
            low += (np.maximum(0, np.maximum(-below, -above)) ** 2)[where]
            high += (np.maximum(below, above) ** 2)[where]
        return np.packbits(low <= high.min(axis=1)[:, None], axis=1)

    def masks(self, parts: np.ndarray) -> np.ndarray:
        """For each part a row of booleans: which entries may be nearest."""
        cells, where = np.unique(parts // self.side, axis=0, return_inverse=True)
        keys = [c.tobytes() for c in cells]
        fresh = [k for k, key in enumerate(keys) if key not in self.known]
        self.asked, self.missed = self.asked + len(parts), self.missed + len(fresh)
        packed = np.zeros((len(cells), (len(self.entries) + 7) // 8), dtype=np.uint8)
        old = np.setdiff1d(np.arange(len(cells)), fresh)
        for k in old.tolist():
            packed[k] = self.known[keys[k]]
        if len(self.known) + len(fresh) > self.most:
            self.known.clear()
        for lo in range(0, len(fresh), SLICE):
            some = fresh[lo : lo + SLICE]
            found = self._undominated(cells[some])
            packed[some] = found
            for k, mask in zip(some, found, strict=True):
                if len(self.known) < self.most:
                    self.known[keys[k]] = mask.copy()
        return np.unpackbits(packed, axis=1, count=len(self.entries)).astype(bool)[where.ravel()]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower) and its squared distance."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.zeros(len(parts), dtype=np.int64)
        if parts.size == 0:
            best[:] = 0
            return index, best
        may = self.masks(parts)
        self.taken += int(may.sum())
        for e in range(len(self.entries)):
            at = np.flatnonzero(may[:, e])
            if len(at):
                apart = parts[at] - self.entries[e]
                d = np.einsum("ij,ij->i", apart, apart)
                nearer = d < best[at]
                best[at[nearer]], index[at[nearer]] = d[nearer], e
        return index, best


def _cells(books: np.ndarray) -> list[Cells]:
    return [Cells(book) for book in books]


def _sums(books: np.ndarray):
    parts, size, width = books.shape

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _cells(books)
        count = np.zeros((parts, size), dtype=np.int64)
        total = np.zeros((parts, size, width), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), parts * width)
            for p in range(parts):
                mine = rows[:, p * width : (p + 1) * width]
                index, _ = cells[p].nearest(mine)
                n, s = group_sums(index, mine, size)
                count[p] += n
                total[p] += s
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()),
                pa.array(e, pa.int32()),
                pa.array(count[p, e], pa.int64()),
                pa.array(total[p, e].tolist(), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    return run


def _codes(books: np.ndarray):
    parts, _, width = books.shape

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _cells(books)
        for batch in batches:
            rows = matrix(batch.column(2), parts * width)
            code = np.empty((len(rows), parts), dtype=np.uint8)
            error = np.zeros(len(rows), dtype=np.int64)
            for p in range(parts):
                index, d = cells[p].nearest(rows[:, p * width : (p + 1) * width])
                code[:, p] = index
                error += d
            text = [c.tobytes().hex() for c in code]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                names=["id", "label", "code", "error"],
            )

    return run


def compress_vectors(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, code, error, label_error) of the kept vectors, and the codebooks (part, entry, component).

    ``code`` has two hex digits a part; ``error`` is the squared distance of a
    vector to what its code stands for, ``label_error`` its sum over equal labels.
    ``entries`` must not exceed 256.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must lie between 1 and 256")
    spark = vectors.sparkSession
    v = F.col(vector_col)
    good = vectors.filter(finite(v))
    usual = good.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    kinds = dict(vectors.dtypes)
    schema = f"id {kinds[id_col]}, label {kinds[label_col]}, code string, error long"
    names = F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"
    if usual is None:
        return spark.createDataFrame([], f"{schema}, label_error long").select(*names), np.zeros((parts, 0, 0), np.int64)
    dims = usual["n"]
    width = -(-dims // parts)
    filled = F.concat(scaled(v, scale), F.array_repeat(F.lit(0), width * parts - dims))
    stored = settle(
        good.filter(F.size(v) == dims).select(
            F.col(id_col).alias("id"), F.col(label_col).alias("label"), filled.alias("v")
        ),
        "code-vectors",
    )
    first = [r["v"] for r in stored.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    books = np.array(first, dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        if width == 0:
            break
        sums = (
            stored.select("v")
            .mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)])
        )
        for r in sums.collect():  # parts * entries rows at most
            books[r["part"], r["entry"]] = [int(r[f"s{d}"]) // r["n"] for d in range(width)]
    coded = settle(stored.mapInArrow(_codes(books), schema), "codes")
    # nulls form one label; a label may hold a third of all rows
    keyed = coded.withColumn("no_label", F.col("label").isNull()).withColumn(
        "key", F.coalesce(F.col("label").cast("string"), F.lit(""))
    )
    labels = keyed.groupBy("no_label", "key").agg(F.count(F.lit(1)).alias("rows"), F.sum("error").alias("label_error"))
    out = join_groups(keyed, labels, ["no_label", "key"], "rows", coded.count())
    return out.select(*names), books
