"""SimHash near duplicates: links of fingerprints by the generalised pigeonhole principle.

A document's 64-bit fingerprint has a bit set where over half of its word
shingles' hashes (XXH64, seed 42) have it. Documents link when their
fingerprints differ in ``REACH`` (3) bits or fewer.

1. One scan makes the fingerprints. Equal ones form one class; only classes
   go on.
2. The bits' correlations over all classes group them into four blocks of 16
   (correlated bits together, so that few blocks are skewed), and all
   classes are counted by block value.
3. Blocks are joined to parts in several ways. Each fingerprint gives each
   part its own threshold t_i >= -1 with sum(t_i + 1) = REACH + 1: two
   fingerprints within reach differ by at most t_i in some part i, whichever
   thresholds the first has. Dynamic programming chooses the thresholds of
   least estimated cost (candidates foretold by the counts, and probes);
   the division into parts of least total cost is taken.
4. Each class is filed under its value of each part and probes all values
   within its thresholds. Where a filing and a probe meet, the whole
   fingerprints are compared. A task passes on a spanning forest of the
   links that it finds, so output is linear in what it reads.
5. Values under which more than ``CELL`` entries meet are cut into cells by
   fingerprint. After the links within cells are joined to components, the
   entries outside the value's main component meet all its cells.
6. Components of the links, passed on to all documents.

The result is exact for connectivity: no link between different
fingerprints is lost, though links inside a component already joined need
not be listed. The tables that go to the tasks have a fixed size: 2^18
counts, and the values that are cut, of which ``CELL`` (which grows with the
data) leaves 2^17 at most.

Defined results: a null or empty text, or one of white space, has the
fingerprint zero and is linked like any other; each row is a document, also
where ids repeat; a null id is reached by no one, so a component of null ids
alone has a null ``component_id``. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import settle
from tripflow.llm.components import components
from tripflow.llm.textnp import mix, parts, runs, squeeze, spread
from tripflow.llm.vectors import join_groups
from tripflow.llm.worker import lean

REACH = 3
BLOCKS, BLOCK_BITS = 4, 16
# Ways to join blocks to parts.
LAYOUTS = (((0,), (1,), (2,), (3,)), ((0,), (1,), (2, 3)), ((0, 1), (2, 3)))
# What sending a probe costs, in comparisons of two fingerprints.
PROBE = 20.0
# Entries of one value that meet in one cell; entries that a bucket should hold; pairs compared at once.
CELL, BUCKET, PAIRS = 2048, 1 << 20, 1 << 20
# Values that are cut into cells at most (two to the power of this).
CUT_BITS = 17
# Words of a text, and entries, that are handled at once.
WORDS, ENTRIES = 1 << 16, 1 << 19
FILED, PROBING = 1, 2


def fingerprint(text: str | None, size: int = 3) -> int:
    """The fingerprint of one text."""
    words = (text or "").encode().lower().split()
    ones, n = np.zeros(64, dtype=np.int64), max(len(words) - size + 1, min(len(words), 1))
    for lo in range(0, n, WORDS):
        some = words[lo : lo + WORDS + size - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
        ends = ends[min(size, len(some)) - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends, strict=False)], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(size: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, 1):
                found = np.array([fingerprint(t.as_py(), size) for t in batch.column(1)], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"]
                )

    return run


def bits_of(fps: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each fingerprint, the highest bit first."""
    return np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy().view(np.uint64)


@lean
def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two bits are set together, as rows (i, n) with i = 64 * bit + bit."""
    total = np.zeros((64, 64), dtype=np.int64)
    for batch in batches:
        x = bits_of(_fps(batch)).astype(np.float64)
        total += (x.T @ x).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], names=["i", "n"])


def group_bits(together: np.ndarray, n: int) -> list[list[int]]:
    """Blocks of bits, correlated ones together; ``together[i, j]`` of ``n`` have both bits."""
    ones = np.diag(together).astype(np.float64)
    spread_of = np.sqrt(np.maximum(ones * (n - ones), 0))
    scale = np.outer(spread_of, spread_of)
    bond = np.divide(np.abs(n * together - np.outer(ones, ones)), scale, out=np.zeros((64, 64)), where=scale > 0)
    np.fill_diagonal(bond, 0)
    left, blocks = list(range(64)), []
    while left:
        inner = bond[np.ix_(left, left)]
        block = [left.pop(int(inner.sum(axis=1).argmax()))]
        while len(block) < BLOCK_BITS:
            block.append(left.pop(int(bond[np.ix_(left, block)].sum(axis=1).argmax())))
        blocks.append(block)
    return blocks


def block_values(fps: np.ndarray, blocks: list[list[int]]) -> np.ndarray:
    """The value of each block, a column each."""
    bits = bits_of(fps)
    pairs = [np.ascontiguousarray(np.packbits(bits[:, b], axis=1)) for b in blocks]
    out = [p.view(">u2").ravel().astype(np.uint64) for p in pairs]
    return np.stack(out, axis=1)


def _block_counts(blocks: list[list[int]]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BLOCKS, 1 << BLOCK_BITS), dtype=np.int64)
        for batch in batches:
            values = block_values(_fps(batch), blocks).astype(np.int64)
            for b in range(BLOCKS):
                total[b] += np.bincount(values[:, b], minlength=1 << BLOCK_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], names=["i", "n"])

    return run


def _added(df: DataFrame, size: int) -> np.ndarray:
    """Rows (i, n) added up by i < size."""
    out = np.zeros(size, dtype=np.int64)
    for r in df.groupBy("i").agg(F.sum("n").alias("n")).collect():  # size rows at most
        out[r["i"]] = r["n"]
    return out


def within(counts: np.ndarray) -> np.ndarray:
    """Classes at each distance 0 to REACH from each value of a block."""
    out = np.zeros((len(counts), REACH + 1))
    out[:, 0] = counts
    values = np.arange(len(counts))
    for bit in range(BLOCK_BITS):
        near = out[values ^ (1 << bit)]
        out[:, 1:] += near[:, :-1]
    return out


class Plan:
    """Blocks, the counts of their values, and the choice of thresholds for one layout."""

    def __init__(self, blocks: list[list[int]], counts: np.ndarray, n: int):
        self.blocks, self.n = blocks, max(n, 1)
        self.near = np.stack([within(c) for c in counts]).astype(np.float32)

    def values(self, fps: np.ndarray, layout) -> np.ndarray:
        """Value of each part; blocks of a part follow one another."""
        by_block = block_values(fps, self.blocks)
        out = np.zeros((len(fps), len(layout)), dtype=np.uint64)
        for p, members in enumerate(layout):
            for b in members:
                out[:, p] = (out[:, p] << np.uint64(BLOCK_BITS)) | by_block[:, b]
        return out

    def thresholds(self, fps: np.ndarray, layout) -> tuple[np.ndarray, np.ndarray]:
        """Each part's threshold (-1: not probed) and the estimated cost."""
        by_block = block_values(fps, self.blocks).astype(np.int64)
        units = REACH + 1
        best = np.full((len(fps), units + 1), np.inf)
        best[:, 0] = 0
        choice = np.zeros((len(fps), len(layout), units + 1), dtype=np.int8)
        for p, members in enumerate(layout):
            share = np.zeros((len(fps), units))
            share[:, 0] = 1
            for b in members:
                one = self.near[b, by_block[:, b]] / self.n
                share = np.stack(
                    [sum(share[:, j] * one[:, d - j] for j in range(d + 1)) for d in range(units)], axis=1
                )
            cost = np.zeros((len(fps), units + 1))
            probes = np.array([len(flips(BLOCK_BITS * len(members), t)) for t in range(units)])
            cost[:, 1:] = np.cumsum(share, axis=1) * self.n + PROBE * probes
            new = np.full_like(best, np.inf)
            for u in range(units + 1):
                for used in range(units + 1 - u):
                    total = best[:, used] + cost[:, u]
                    better = total < new[:, used + u]
                    new[better, used + u] = total[better]
                    choice[better, p, used + u] = u
            best = new
        left = np.full(len(fps), units)
        out = np.zeros((len(fps), len(layout)), dtype=np.int64)
        for p in range(len(layout) - 1, -1, -1):
            u = choice[np.arange(len(fps)), p, left]
            out[:, p] = u - 1
            left = left - u
        return out, best[:, units]


_flips: dict[tuple[int, int], np.ndarray] = {}


def flips(width: int, most: int) -> np.ndarray:
    """All masks of up to ``most`` of ``width`` bits, none set first."""
    if (width, most) not in _flips:
        masks = [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(width), k)]
        _flips[width, most] = np.array(masks, dtype=np.uint64)
    return _flips[width, most]


def _costs(shared):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        cost, sent = np.zeros(len(LAYOUTS)), np.zeros(len(LAYOUTS))
        for batch in batches:
            fps = _fps(batch)
            for k, layout in enumerate(LAYOUTS):
                t, c = plan.thresholds(fps, layout)
                cost[k] += c.sum()
                for p, members in enumerate(layout):
                    for u in range(REACH + 1):
                        sent[k] += (t[:, p] == u).sum() * len(flips(BLOCK_BITS * len(members), u))
                    sent[k] += (t[:, p] < 0).sum()
        ids = pa.array(range(len(LAYOUTS)), pa.int32())
        yield pa.RecordBatch.from_arrays([ids, pa.array(cost), pa.array(sent)], names=["k", "cost", "sent"])

    return run


def value_key(part: np.ndarray | int, value: np.ndarray) -> np.ndarray:
    """One number for a value of a part; different ones for different values of a part."""
    return mix(value ^ (np.uint64(0x9E3779B97F4A7C15) * (np.asarray(part, dtype=np.uint64) + np.uint64(1))))


def entries(fps: np.ndarray, plan: Plan, layout) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Filings and probes as arrays (key, fp, role), of bounded length each."""
    values = plan.values(fps, layout)
    limits, _ = plan.thresholds(fps, layout)
    for p, members in enumerate(layout):
        for t in range(-1, REACH + 1):
            at = np.flatnonzero(limits[:, p] == t)
            masks = flips(BLOCK_BITS * len(members), max(t, 0))
            step = max(1, ENTRIES // len(masks))
            for lo in range(0, len(at), step):
                some = at[lo : lo + step]
                key = value_key(p, (values[some, p][:, None] ^ masks[None, :]).ravel())
                role = np.full((len(some), len(masks)), PROBING, dtype=np.uint8)
                role[:, 0] = FILED if t < 0 else FILED | PROBING
                yield key, np.repeat(fps[some], len(masks)), role.ravel()


PACKED = "bucket long, n int, key binary, fp binary, role binary"


def _packed(key: np.ndarray, fps: np.ndarray, role: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Entries as one row a bucket."""
    bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
    at = np.argsort(bucket, kind="stable")
    begin = np.flatnonzero(np.diff(bucket[at], prepend=-1))
    ends = np.append(begin[1:], len(at))
    rows = [at[a:b] for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
    columns = [pa.array([squeeze(c[r]) for r in rows], pa.binary()) for c in (key, fps, role)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[at][begin], pa.int64()), pa.array(ends - begin, pa.int32()), *columns],
        names=["bucket", "n", "key", "fp", "role"],
    )


class Cuts:
    """The values that are cut into cells, and the number of cells of each."""

    def __init__(self, keys: np.ndarray, cells: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.cells = keys[order], cells[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Cells of each key; one where it isn't cut."""
        out = np.ones(len(keys), dtype=np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.cells[at[hit]]
        return out


def _key_counts(shared, layout):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, _, _ in entries(_fps(batch), shared.value, layout):
                found, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["key", "n"])

    return run


def _filed(shared, cuts, layout, buckets: int):
    """All entries, those of a cut value in the cell of their fingerprint."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, fps, role in entries(_fps(batch), shared.value, layout):
                cells = cuts.value.of(key).astype(np.uint64)
                in_cell = mix(key ^ mix(mix(fps) % cells + np.uint64(0x5851F42D4C957F2D)))
                yield _packed(np.where(cells > 1, in_cell, key), fps, role, buckets)

    return run


def _of_cut_values(shared, cuts, layout):
    """Entries of cut values as rows."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, fps, role in entries(_fps(batch), shared.value, layout):
                cells = cuts.value.of(key)
                at = np.flatnonzero(cells > 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[at].view(np.int64)),
                        pa.array(fps[at].view(np.int64)),
                        pa.array(role[at].astype(np.int32)),
                        pa.array(cells[at]),
                    ],
                    names=["key", "fp", "role", "cells"],
                )

    return run


def _pack_rows(buckets: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, fps = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
                yield _packed(key, fps, batch.column(2).to_numpy().astype(np.uint8), buckets)

    return run


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same nodes as the edges (a, b) do, fewer than there are nodes."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        u, v = root[x], root[y]
        open_ = u != v
        x, y, u, v = x[open_], y[open_], u[open_], v[open_]
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    out = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[out], nodes[root[out]]


def links_within(key: np.ndarray, fps: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between a probe and a filing of one key."""
    # within a key: filed only, filed and probing, probing only
    at = np.lexsort((np.array([0, 0, 2, 1], dtype=np.uint8)[role], key))
    key, fps, role = key[at], fps[at], role[at]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.append(begin[1:], len(key))
    filed = np.add.reduceat((role & FILED) > 0, begin, dtype=np.int64)
    probing = np.add.reduceat((role & PROBING) > 0, begin, dtype=np.int64)
    busy = (filed > 0) & (probing > 0) & (ends - begin > 1)
    begin, ends, filed, probing = begin[busy], ends[busy], filed[busy], probing[busy]
    # each probe with the run of filings that it meets
    probe = runs(ends - probing, probing, np.arange(len(begin)))
    start, many = np.repeat(begin, probing), np.repeat(filed, probing)
    a, b = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    done = np.concatenate([[0], np.cumsum(many)])
    lo = 0
    while lo < len(probe):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIRS, side="right")) - 1)
        x = np.repeat(fps[probe[lo:hi]], many[lo:hi])
        y = fps[runs(start[lo:hi], many[lo:hi], np.arange(hi - lo))]
        near = (np.bitwise_count(x ^ y) <= REACH) & (x != y)
        a, b = np.concatenate([a, x[near]]), np.concatenate([b, y[near]])
        if len(a) > PAIRS:
            a, b = forest(a, b)
        lo = hi
    return forest(a, b)


@lean
def _link(table: pa.Table) -> pa.Table:
    rows = table.select(["n", "key", "fp", "role"]).to_pylist()
    key, fps, role = (
        np.concatenate([spread(r[c], kind, r["n"]) for r in rows])
        for c, kind in (("key", np.uint64), ("fp", np.uint64), ("role", np.uint8))
    )
    a, b = links_within(key, fps, role)
    return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def _met(packed: DataFrame) -> DataFrame:
    return packed.groupBy("bucket").applyInArrow(_link, "a long, b long")


def _between_cells(classes: DataFrame, shared, cuts, layout, roots: DataFrame, cell: int) -> DataFrame:
    """Links of entries outside the main component of a cut value with all entries of that value.

    Both sides are dealt to a grid of cells, so that no task holds a whole value.
    """
    rows = classes.select("fp").mapInArrow(
        _of_cut_values(shared, cuts, layout), "key long, fp long, role int, cells long"
    )
    named = settle(
        rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "simhash-cut",
    )
    by_root = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = settle(
        by_root.groupBy("key").agg(F.max_by("root", "n").alias("main"), (F.sum("n") - F.max("n")).alias("out"))
        .filter("out > 0").withColumn("guest_cells", F.ceil(F.col("out") / cell)),
        "simhash-main",
    )
    # one row a cut value, so at most 2^CUT_BITS
    told = named.join(F.broadcast(main), "key").withColumn("home", F.pmod(F.xxhash64("fp"), F.col("cells")))
    guest_cell = F.pmod(F.xxhash64("fp"), F.col("guest_cells"))
    homes = told.withColumn("i", F.col("home")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("guest_cells") - 1))
    )
    guests = told.filter("root <> main").withColumn("j", guest_cell).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    )

    def sided(df: DataFrame, role: int, side: int, as_: int) -> DataFrame:
        return df.filter(F.col("role").bitwiseAND(role) > 0).select(
            F.xxhash64("key", "i", "j", F.lit(side)).alias("key"), "fp", F.lit(as_).alias("role")
        )

    both = (
        sided(homes, FILED, 1, FILED)
        .unionByName(sided(guests, PROBING, 1, PROBING))
        .unionByName(sided(homes, PROBING, 2, PROBING))
        .unionByName(sided(guests, FILED, 2, FILED))
    )
    total = main.agg(F.sum("out")).first()[0]
    if not total:
        return classes.sparkSession.createDataFrame([], "a long, b long")
    buckets = int(both.count() // BUCKET + 1)
    return _met(both.mapInArrow(_pack_rows(buckets), PACKED))


def class_links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that join the fingerprints in column ``fp`` (each once) as all their links would.

    An edge stands for a chain of links, so its ends may differ in more bits.
    """
    spark = classes.sparkSession
    context = spark.sparkContext
    fps = classes.select("fp")
    together = _added(fps.mapInArrow(_together, "i int, n long"), 64 * 64).reshape(64, 64)
    n = fps.count()
    blocks = group_bits(together, n)
    counts = _added(fps.mapInArrow(_block_counts(blocks), "i int, n long"), BLOCKS << BLOCK_BITS)
    shared = context.broadcast(Plan(blocks, counts.reshape(BLOCKS, -1), n))
    costs = fps.mapInArrow(_costs(shared), "k int, cost double, sent double").groupBy("k").agg(
        F.sum("cost").alias("cost"), F.sum("sent").alias("sent")
    )
    best = min(costs.collect(), key=lambda r: (r["cost"], r["k"]), default=None)  # a row a layout
    if best is None:
        return spark.createDataFrame([], "a long, b long")
    layout = LAYOUTS[best["k"]]
    counted = settle(
        fps.mapInArrow(_key_counts(shared, layout), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        .filter(F.col("n") > CELL),
        "simhash-values",
    )
    cell = CELL
    while counted.filter(F.col("n") > cell).count() > 1 << CUT_BITS:
        cell *= 2
    many = counted.filter(F.col("n") > cell).collect()  # 2^CUT_BITS rows at most
    keys = np.array([r["key"] for r in many], dtype=np.int64).view(np.uint64)
    cuts = context.broadcast(Cuts(keys, np.array([-(-r["n"] // cell) for r in many], dtype=np.int64)))
    buckets = int(best["sent"] // BUCKET + 1)
    links = settle(_met(fps.mapInArrow(_filed(shared, cuts, layout, buckets), PACKED)), "simhash-links")
    if many:
        more = _between_cells(classes, shared, cuts, layout, components(links), cell)
        links = links.unionByName(settle(more, "simhash-links"))
    return links


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fp (the fingerprint as a long)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(size), f"id {dict(rows.dtypes)['id']}, fp long")


def near_groups(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), group_size (rows with that fingerprint), component_id."""
    rows = settle(fingerprints(docs, size, id_col, text_col), "simhash")
    classes = settle(
        rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("group_size")), "simhash-classes"
    )
    roots = components(class_links(classes))
    named = settle(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "simhash-roots",
    )
    found = settle(
        named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes")),
        "simhash-found",
    )
    told = settle(join_groups(named, found, ["root"], "classes", named.count()), "simhash-told")
    out = join_groups(rows, told.select("fp", "group_size", "component_id"), ["fp"], "group_size", rows.count())
    return out.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "group_size", "component_id"
    )
