"""Jaccard join of documents on word shingles, by adaptive multi-match prefixes.

All shingles have one global order, rare ones first, from a table of counts
by shingle hash (fixed size; every shingle of every document is counted). A
pair with similarity ``t`` shares at least ``ceil(t * n)`` shingles of a set
of ``n``; so the first ``k`` shingles that it shares lie in the first
``n - ceil(t * n) + k`` of both sets. Each document chooses its own ``k``:
the more candidates the counts foretell for its prefix, the longer the
prefix and the more shingles a pair must share there before it is verified
(the smaller ``k`` of the two).

1. One scan makes each document's number of shingles and a key of its set,
   and the counts. Documents with equal sets form one class; only one of
   each goes on.
2. A second scan counts the shingles of the prefixes exactly; those of more
   than ``SMALL`` prefixes are hot and go to the end of the order (as a bit set
   of bounded size). A third scan packs the prefixes of the new order by
   shingle. Shingles yield pairs, added up by pair; the few that have more
   than ``SMALL`` prefixes in the new order yield chains by set size, so that
   no shingle makes more than linear rows.
3. A prefix holds no hot shingle, unless hot ones are so many of a set that
   its shortest prefix reaches them. Two such sets that share no other
   shingle are as similar as their hot shingles make them: so all sets with
   equal hot shingles and equal size are one *core*, joined by a core's
   links (also with itself). Cores are joined like documents, by their
   hot shingles. So a passage that many documents share makes a few cores
   to compare, whatever the number of documents.
4. Components of these candidates are clusters; every link lies within one.
   Each set is sent once, to its cluster. There, documents are compared with
   those of other components only (multi-match first, then the exact sets),
   until nothing is left to link. Clusters of more than ``BLOCK`` documents
   are cut into blocks; documents that are not in the cluster's main
   component are then compared with the other blocks, in a grid of blocks.
5. Components of the verified links, passed on to all copies.

The result is exact for connectivity: no link between different texts is
lost, though links inside a component already joined need not be listed.
Shingles, sets and cores are compared by 64-bit hashes.

Defined results: a null or empty text has no shingles and is linked with
nothing; ids must be integers; a null id counts as smaller than all others;
each row is a document, also where ids repeat (fully repeated rows are
linked, if they have a shingle); of rows with one id the one with the
smaller hash of its text comes first. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bitmaps import MAX_BITS, bit_set, position, with_test
from tripflow.llm.common import NO_ID, keyed_rows, power_of_two, settle
from tripflow.llm.components import components
from tripflow.llm.textnp import (
    byte_symbols,
    mix,
    parts,
    span_hashes,
    spread,
    squeeze,
    text_bytes,
    windows,
    word_spans,
)
from tripflow.llm.vectors import join_groups
from tripflow.llm.worker import lean

# Width of the count table at least and at most; documents of a prefix shingle that are paired directly.
WIDTH, MOST_WIDTH, SMALL = 1 << 20, 1 << 21, 24
# Documents of a cluster that one task compares; bytes of sets that a task takes.
BLOCK, TASK_BYTES = 4096, 16 << 20
# Documents of a block that are compared with all others before its main component is left out.
WARM = 48
PART = 1 << 22
SLICES = 64
# Shingles that a bucket of prefixes should hold, of which each takes some bytes of text.
BUCKET_BYTES = 16 << 20
HOT_BITS, MOST_HOT_BITS = 1 << 20, 1 << 27


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    at = windows(first, size)
    hashes = span_hashes(words, at, at + size)
    cuts = np.searchsorted(at, first)
    for k in range(len(first) - 1):
        n = first[k + 1] - first[k]
        if 0 < n < size:
            yield span_hashes(words, first[k : k + 1], first[k + 1 : k + 2])
        else:
            yield np.unique(hashes[cuts[k] : cuts[k + 1]])


def _sets(batch: pa.RecordBatch, size: int, symbols: np.ndarray) -> Iterator[np.ndarray]:
    """The shingles of each text; the text is the batch's last column."""
    data, offsets = text_bytes(batch.column(batch.num_columns - 1))
    begin, end, first = word_spans(data, offsets)
    return shingles(span_hashes(symbols[data], begin, end), first, size)


def set_key(s: np.ndarray) -> int:
    """One signed number for a set, whatever its order."""
    both = np.array([len(s), s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)], dtype=np.uint64)
    with np.errstate(over="ignore"):
        both = mix(both * np.array([3, 5, 7], dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D))
        return int(mix(both.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _signatures(size: int, width: int):
    """Rows of documents (slice -1) and of partial counts (slice 0 and up)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, counts = byte_symbols(lower=True), np.zeros(width, dtype=np.int32)
        names = ["slice", "id", "tie", "n", "cls", "counts"]
        for whole in batches:
            for batch in parts(whole, 2, PART):
                n, cls, every = [], [], []
                for s in _sets(batch, size, symbols):
                    n.append(len(s))
                    cls.append(set_key(s))
                    every.append(s)
                seen = np.bincount(np.concatenate(every) % np.uint64(width), minlength=width)
                np.add(counts, seen, out=counts, casting="unsafe")
                rows = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, -1, dtype=np.int32)),
                        batch.column(0),
                        batch.column(1),
                        pa.array(n, pa.int64()),
                        pa.array(cls, pa.int64()),
                        pa.nulls(rows, pa.binary()),
                    ],
                    names=names,
                )
        if counts.any():
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(SLICES, dtype=np.int32)),
                    *[none] * 4,
                    pa.array([squeeze(x) for x in np.split(counts, SLICES)], pa.binary()),
                ],
                names=names,
            )

    return run


def _add_counts(width: int):
    """The rarity class of each cell of a slice (more for commoner shingles), and their counts together."""

    @lean
    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(width // SLICES, dtype=np.int64)
        for blob in table.column("counts").to_pylist():
            total += spread(blob, np.int32, len(total))
        rank = np.minimum(254, 4 * np.log2(total + 1.0)).astype(np.uint8)
        return pa.table(
            {
                "slice": table.column("slice")[:1],
                "rank": pa.array([rank.tobytes()], pa.binary()),
                "total": pa.array([int(total.sum())], pa.int64()),
            }
        )

    return run


def hot_key(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Position of a shingle in the bit set of hot ones."""
    return (mix(tokens) % np.uint64(bits)).astype(np.int64)


class Prefix:
    """A set in the global order, and what of it is matched.

    ``cold`` shingles come first; the first ``length`` are the prefix, of which
    ``match`` at least must be shared. ``core`` is the number of hot shingles
    that the shortest prefix reaches (0: it has none).
    """

    __slots__ = ("cold", "core", "length", "match", "tokens")

    def __init__(self, tokens: np.ndarray, cold: int, match: int, length: int, core: int):
        self.tokens, self.cold, self.match, self.length, self.core = tokens, cold, match, length, core


class Order:
    """The global order of shingles and the choice of prefixes."""

    def __init__(self, rank: np.ndarray, mean: float, num: int, den: int, hot: np.ndarray | None = None):
        self.rank, self.num, self.den, self.hot = rank, num, den, hot
        # documents that share a shingle: beyond what the table's width lets coincide,
        # and as many as that chance leaves uncertain
        seen = 2.0 ** (np.arange(256) / 4) - 1
        self.others = np.maximum(0, seen - 1 - mean) + np.sqrt(mean) * (mean > 1)

    def least(self, n: int) -> int:
        """Shingles of a set of ``n`` that a partner shares at least."""
        return -(-self.num * n // self.den)

    def arrange(self, s: np.ndarray) -> Prefix:
        rank = self.rank[s % np.uint64(len(self.rank))]
        if self.hot is not None:
            at = hot_key(s, 8 * len(self.hot))
            rank = np.where((self.hot[at >> 3] >> (at & 7).astype(np.uint8)) & 1, np.uint8(255), rank)
        order = np.argsort(rank, kind="stable")
        n = len(s)
        least = self.least(n)
        shortest = n - least + 1
        cold = n if self.hot is None else int((rank != 255).sum())
        if cold < shortest:
            return Prefix(s[order], cold, 1, cold, shortest - cold)
        cost = float(self.others[rank[order[:shortest]]].sum())
        match = min(least, 1 + int(np.ceil(np.log2(1 + cost))), cold - (n - least))
        return Prefix(s[order], cold, match, n - least + match, 0)


def _packed(bucket: np.ndarray, token: np.ndarray, ids: np.ndarray, n: np.ndarray, match: np.ndarray) -> list[tuple]:
    """A row (bucket, k, token, id, n, match) for each bucket that occurs."""
    at = np.argsort(bucket, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(bucket[at].astype(np.int64), prepend=-1)), len(at)).tolist()
    rows = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        cut = at[lo:hi]
        rows.append(
            (
                int(bucket[cut[0]]),
                len(cut),
                token[cut].tobytes(),
                ids[cut].tobytes(),
                squeeze(n[cut]),
                squeeze(match[cut]),
            )
        )
    return rows


def _dealt(keys: np.ndarray, buckets: int) -> np.ndarray:
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    return (mix(keys ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(buckets)).astype(kind)


def _prefixes(size: int, buckets: int, order):
    """Prefixes by shingle, and in buckets below 0 the sets that have a core."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, by = byte_symbols(lower=True), order.value
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
        for whole in batches:
            for batch in parts(whole, batch_text(whole), PART):
                token, cls, n, match, long, cores = [], [], [], [], [], []
                for s in _sets(batch, size, symbols):
                    if len(s):
                        p = by.arrange(s)
                        key = set_key(s)
                        token.append(p.tokens[: p.length])
                        cls.append(key)
                        n.append(len(s))
                        match.append(p.match)
                        long.append(p.length)
                        if p.core:
                            cores.append((key, core_key(p), len(s), len(s) - p.cold))
                rows = []
                if sum(long):
                    t = np.concatenate(token)
                    values = (
                        np.repeat(np.array(x, dtype=kind), long)
                        for x, kind in ((cls, np.int64), (n, np.int32), (match, np.uint8))
                    )
                    rows = _packed(_dealt(t, buckets), t, *values)
                if cores:
                    key, core, total, hot = (np.array(x, dtype=np.int64) for x in zip(*cores, strict=True))
                    deal = _dealt(core.view(np.uint64), buckets).astype(np.int64)
                    for b, *values in _packed(deal, core, key, total.astype(np.int32), hot.astype(np.int32)):
                        rows.append((-1 - b, *values))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names=["bucket", "k", "token", "id", "n", "match"],
                    )

    return run


def batch_text(batch: pa.RecordBatch) -> int:
    return batch.num_columns - 1


def core_key(p: Prefix) -> int:
    """One signed number for the hot shingles and the size of a set."""
    return set_key(np.append(p.tokens[p.cold :], np.uint64(len(p.tokens))))


def _core_prefixes(size: int, buckets: int, order):
    """What the shortest prefixes have of hot shingles, by shingle, under the key of the core."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, by = byte_symbols(lower=True), order.value
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
        for whole in batches:
            for batch in parts(whole, batch_text(whole), PART):
                found: dict[int, Prefix] = {}
                for s in _sets(batch, size, symbols):
                    if len(s):
                        p = by.arrange(s)
                        if p.core:
                            found.setdefault(core_key(p), p)
                if not found:
                    continue
                long = [p.core for p in found.values()]
                t = np.concatenate([p.tokens[p.cold : p.cold + p.core] for p in found.values()])
                ids = np.repeat(np.array(list(found), dtype=np.int64), long)
                n = np.repeat(np.array([len(p.tokens) for p in found.values()], dtype=np.int32), long)
                rows = _packed(_dealt(t, buckets), t, ids, n, np.ones(len(t), dtype=np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["bucket", "k", "token", "id", "n", "match"],
                )

    return run


PREFIX_ROWS = "bucket int, k int, token binary, id binary, n binary, match binary"


@lean
def _hot(table: pa.Table) -> pa.Table:
    """The shingles of a bucket that more than ``SMALL`` prefixes hold."""
    token = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table.column("token").to_pylist()])
    token, many = np.unique(token, return_counts=True)
    return pa.table({"token": pa.array(token[many > SMALL].view(np.int64))})


def _hot_positions(bits: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = hot_key(batch.column(0).to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at) + 1)], names=["p"])

    return run


# kind 0: a pair; kind 1: set ``a`` has core ``b`` of ``shared`` hot shingles, and size ``need``
PAIR_ROWS = "kind int, a long, b long, shared long, need long"
CERTAIN = 1 << 30


def _core_rows(table: pa.Table) -> pa.Table:
    out: dict[str, list] = {name: [] for name in ("a", "b", "shared", "need")}
    for r in table.to_pylist():
        out["a"].append(np.frombuffer(r["id"], dtype=np.int64))
        out["b"].append(np.frombuffer(r["token"], dtype=np.int64))
        out["shared"].append(spread(r["match"], np.int32, r["k"]).astype(np.int64))
        out["need"].append(spread(r["n"], np.int32, r["k"]).astype(np.int64))
    columns = {name: np.concatenate(x) for name, x in out.items()}
    at = np.unique(np.stack([columns["b"], columns["a"]]), axis=1, return_index=True)[1]
    kind = pa.array(np.ones(len(at), dtype=np.int32))
    return pa.table({"kind": kind, **{name: pa.array(x[at]) for name, x in columns.items()}})


def _candidates(num: int, den: int):
    @lean
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return _core_rows(table)
        token, ids, n, match = [], [], [], []
        for r in table.to_pylist():
            token.append(np.frombuffer(r["token"], dtype=np.uint64))
            ids.append(np.frombuffer(r["id"], dtype=np.int64))
            n.append(spread(r["n"], np.int32, r["k"]))
            match.append(spread(r["match"], np.uint8, r["k"]))
        token, ids = np.concatenate(token), np.concatenate(ids)
        n, match = np.concatenate(n).astype(np.int64), np.concatenate(match).astype(np.int64)
        at = np.lexsort((ids, n, token))
        token, ids, n, match = token[at], ids[at], n[at], match[at]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (ids[1:] != ids[:-1])])
        token, ids, n, match = token[new], ids[new], n[new], match[new]
        begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        many = np.diff(np.append(begin, len(token)))
        left, right, sure = [], [], []
        for m in range(2, SMALL + 1):
            lead = begin[many == m]
            if len(lead):
                i, j = np.triu_indices(m, 1)
                left.append((lead[:, None] + i).ravel())
                right.append((lead[:, None] + j).ravel())
                sure.append(np.zeros(len(left[-1]), dtype=bool))
        for lead, m in zip(begin[many > SMALL].tolist(), many[many > SMALL].tolist(), strict=True):
            left.append(np.arange(lead, lead + m - 1))
            right.append(left[-1] + 1)
            sure.append(np.ones(m - 1, dtype=bool))
        empty = np.empty(0, dtype=np.int64)
        i = np.concatenate(left) if left else empty
        j = np.concatenate(right) if right else empty
        certain = np.concatenate(sure) if sure else empty.astype(bool)
        # sizes ascend within a shingle; a larger set of too different size can't match
        fits = (den * n[i] >= num * n[j]) & (ids[i] != ids[j])
        i, j, certain = i[fits], j[fits], certain[fits]
        a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        shared, need = np.where(certain, CERTAIN, 1), np.minimum(match[i], match[j])
        at = np.lexsort((b, a))
        a, b, shared, need = a[at], b[at], shared[at], need[at]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else empty.astype(bool)
        first = np.flatnonzero(new)
        added = np.add.reduceat(shared, first) if len(first) else empty
        return pa.table(
            {
                "kind": pa.array(np.zeros(len(first), dtype=np.int32)),
                "a": pa.array(a[first], pa.int64()),
                "b": pa.array(b[first], pa.int64()),
                "shared": pa.array(added, pa.int64()),
                "need": pa.array(need[first], pa.int64()),
            }
        )

    return run


SETS = "id long, match int, prefix int, total int, tokens binary"


def _arranged(size: int, order, cores: bool):
    """Sets in the global order; with ``cores`` the hot shingles of those that have a core, under its key."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, by = byte_symbols(lower=True), order.value
        for whole in batches:
            for batch in parts(whole, batch_text(whole), PART):
                rows: dict[int, tuple] = {}
                for s in _sets(batch, size, symbols):
                    if not len(s):
                        continue
                    p = by.arrange(s)
                    if not cores:
                        rows[set_key(s)] = (p.match, p.length, len(s), p.tokens.tobytes())
                    elif p.core:
                        rows[core_key(p)] = (1, p.core, len(s), p.tokens[p.cold :].tobytes())
                columns = list(zip(*rows.values(), strict=True)) or [[]] * 4
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rows), pa.int64()), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
                    names=["id", "match", "prefix", "total", "tokens"],
                )

    return run


def _hits(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which ``values`` are among the sorted ``wanted``."""
    at = np.searchsorted(wanted, values)
    at[at == len(wanted)] = 0
    return wanted[at] == values


def link_cluster(
    sets: list[np.ndarray],
    size: np.ndarray,
    match: np.ndarray,
    prefix: np.ndarray,
    label: np.ndarray,
    leads: np.ndarray,
    num: int,
    den: int,
) -> list[tuple[int, int]]:
    """Links that join the documents as all their links would.

    ``size`` has the documents' numbers of shingles (a core's set has only the
    hot ones); ``label`` components known so far (changed in place); ``leads``
    the documents to compare with all others. A document is compared only
    with those of other components.
    """
    heads = np.concatenate([s[:p] for s, p in zip(sets, prefix, strict=True)])
    head_of = np.repeat(np.arange(len(sets)), prefix)
    links, anchor = [], -1
    for turn, x in enumerate(leads.tolist()):
        # where all lead, the others find the links to the component that most are in by now
        if turn == WARM and len(leads) == len(sets):
            anchor = int(np.flatnonzero(label == np.bincount(label).argmax())[0])
        if anchor >= 0 and label[x] == label[anchor]:
            continue
        apart = label != label[x]
        if not apart.any():
            continue
        near = apart & (den * np.minimum(size, size[x]) >= num * np.maximum(size, size[x]))
        if not near.any():
            continue
        shared = np.bincount(head_of[_hits(heads, np.sort(sets[x][: prefix[x]]))], minlength=len(sets))
        wanted = np.sort(sets[x])
        for y in np.flatnonzero(near & (shared >= np.minimum(match, match[x]))).tolist():
            if label[y] == label[x]:
                continue
            both = int(_hits(sets[y], wanted).sum())
            if den * both >= num * (size[x] + size[y] - both):
                links.append((x, y))
                label[label == label[y]] = label[x]
    return links


def _link(num: int, den: int):
    @lean
    def run(table: pa.Table) -> pa.Table:
        cluster = table.column("cluster").to_numpy()
        block = table.column("block").to_numpy()
        out: list[tuple[int, int]] = []
        at = np.lexsort((block, cluster))
        new = np.concatenate(
            [[True], (cluster[at][1:] != cluster[at][:-1]) | (block[at][1:] != block[at][:-1])]
        )
        for rows in np.split(at, np.flatnonzero(new)[1:]):
            part = table.take(pa.array(rows))
            ids = part.column("id").to_numpy()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in part.column("tokens").to_pylist()]
            match, prefix = part.column("match").to_numpy(), part.column("prefix").to_numpy()
            size = part.column("total").to_numpy().astype(np.int64)
            _, label = np.unique(part.column("label").to_numpy(), return_inverse=True)
            lead = np.flatnonzero(part.column("lead").to_numpy(zero_copy_only=False))
            lead = lead[np.argsort(ids[lead], kind="stable")]
            out += [
                (int(ids[x]), int(ids[y])) for x, y in link_cluster(sets, size, match, prefix, label, lead, num, den)
            ]
        return pa.table(
            {"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())}
        )

    return run


def _compare(rows: DataFrame, num: int, den: int) -> DataFrame:
    return rows.groupBy("task").applyInArrow(_link(num, den), "a long, b long")


def _verified(found: DataFrame, num: int, den: int, total_bytes: int) -> DataFrame:
    """Verified links (a, b) of clusters, given rows (id, cluster, size, bytes, match, prefix, total, tokens).

    A large cluster is cut into bands of like numbers of shingles (only
    neighbouring bands can link) and those into blocks of bounded size.
    """
    tasks = max(1, total_bytes // TASK_BYTES + 1)
    large = (F.col("size") > BLOCK) | (F.col("bytes") > TASK_BYTES)
    band = F.floor(F.log(F.col("total")) / float(np.log(den / num)) - 1e-9) if num < den else F.col("total")
    placed = found.withColumn("band", F.when(large, band.cast("long")))
    small = placed.filter(~large).withColumns(
        {"block": F.lit(0), "task": F.pmod(F.xxhash64("cluster"), F.lit(tasks)), "label": F.col("id"), "lead": F.lit(True)}
    )
    cut = settle(placed.filter(large), "ngram-large")
    links = settle(_compare(small, num, den), "ngram-links")
    if cut.isEmpty():
        return links
    keys = ["cluster", "band"]

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        count = F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.col("total").cast("double")) * 8 / TASK_BYTES)
        )
        return rows.groupBy(*keys).agg(count.cast("int").alias(name))

    homes = settle(blocks(cut, "homes"), "ngram-blocks")
    at = cut.join(homes, keys).withColumn("block", F.pmod(F.xxhash64("id"), F.col("homes")).cast("int"))
    own = at.withColumns({"task": F.xxhash64(*keys, "block"), "label": F.col("id"), "lead": F.lit(True)})
    links = links.unionByName(settle(_compare(own, num, den), "ngram-links"))
    # whoever is not in its cluster's main component meets all blocks that its size lets it link with
    roots = components(links)
    named = at.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("root", "id")).drop("root")
    counts = named.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("k"))
    main = counts.groupBy("cluster").agg(F.max(F.struct("k", "label")).alias("top"))
    named = settle(named.join(main.select("cluster", F.col("top.label").alias("main")), "cluster"), "ngram-named")
    near = F.array(*(F.col("band") + k for k in ((-1, 0, 1) if num < den else (0,))))
    guests = named.filter("label <> main").withColumn("band", F.explode(near)).drop("homes")
    parties = settle(blocks(guests, "parties").join(homes, keys), "ngram-parties")
    if parties.isEmpty():
        return links
    guests = (
        guests.join(parties, keys)
        .withColumn("party", F.pmod(F.xxhash64("id"), F.col("parties")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
        .withColumn("lead", F.lit(True))
    )
    hosts = (
        named.drop("homes")
        .join(parties, keys)
        .withColumn("party", F.explode(F.sequence(F.lit(0), F.col("parties") - 1)))
        .withColumn("lead", F.lit(False))
    )
    both = guests.unionByName(hosts).withColumn("task", F.xxhash64(*keys, "block", "party"))
    return links.unionByName(settle(_compare(both, num, den), "ngram-links"))


def _collected_bits(positions: DataFrame, bits: int) -> np.ndarray:
    """A bit set (of bounded size) of the positions plus one in column ``p``."""
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in bit_set(positions, "p").toLocalIterator():
        lo = (r["bucket"] - 1) * 4096
        out[lo : lo + 4096] = np.frombuffer(r["bitmap"], dtype=np.uint8)
    return out


def linked_rows(rows: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Rows (id, tie, n, component) of rows (id, tie, text); ``component`` is the smallest (id, tie) reached."""
    spark = rows.sparkSession
    context = spark.sparkContext
    text_bytes_all = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = power_of_two(text_bytes_all >> 8, WIDTH, MOST_WIDTH)
    seen = settle(
        rows.select("id", "tie", "text").mapInArrow(
            _signatures(size, width), "slice int, id long, tie long, n long, cls long, counts binary"
        ),
        "ngram-signatures",
    )
    signed = seen.filter("slice < 0").select("id", "tie", "n", "cls")
    added = (
        seen.filter("slice >= 0").select("slice", "counts").groupBy("slice")
        .applyInArrow(_add_counts(width), "slice int, rank binary, total long")
    )
    rank, mean = np.zeros(width, dtype=np.uint8), 0.0
    for r in added.collect():  # SLICES rows, of ``width`` bytes together
        lo = r["slice"] * (width // SLICES)
        rank[lo : lo + width // SLICES] = np.frombuffer(r["rank"], dtype=np.uint8)
        mean += r["total"] / width
    classes = settle(
        signed.filter("n > 0").groupBy("cls", "n").agg(F.min(F.struct("id", "tie")).alias("least"), F.count(F.lit(1)).alias("k")),
        "ngram-classes",
    )
    bits = power_of_two(16 * classes.count(), 1 << 16, MAX_BITS)
    buckets = max(1, min((1 << 31) - 1, text_bytes_all // BUCKET_BYTES + 1))

    def chosen(ids: DataFrame) -> DataFrame:
        """The texts of some ids, and maybe of a few others."""
        some = settle(bit_set(ids.select(position(F.col("id"), bits).alias("p")), "p"), "ngram-chosen")
        return with_test(rows.withColumn("_p", position(F.col("id"), bits)), "_p", some, "_in").filter("_in").select("text")

    reps = chosen(classes.select("least.id"))
    first = context.broadcast(Order(rank, mean, num, den))
    packed = reps.mapInArrow(_prefixes(size, buckets, first), PREFIX_ROWS)
    many = settle(packed.select("bucket", "token").groupBy("bucket").applyInArrow(_hot, "token long"), "ngram-hot")
    first.unpersist()
    hot_bits = power_of_two(16 * many.count(), HOT_BITS, MOST_HOT_BITS)
    hot = _collected_bits(many.mapInArrow(_hot_positions(hot_bits), "p long"), hot_bits)
    order = context.broadcast(Order(rank, mean, num, den, hot))

    def paired(packed: DataFrame) -> DataFrame:
        return packed.groupBy("bucket").applyInArrow(_candidates(num, den), PAIR_ROWS)

    def added_up(pairs: DataFrame) -> DataFrame:
        shared = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need"))
        return shared.filter("shared >= need").select("a", "b")

    met = settle(paired(reps.mapInArrow(_prefixes(size, buckets, order), PREFIX_ROWS)), "ngram-pairs")
    pairs = added_up(met.filter("kind = 0"))
    in_core = met.filter("kind = 1").select("a", F.col("b").alias("core"), F.col("shared").alias("hot"), F.col("need").alias("n"))
    cores = settle(
        in_core.groupBy("core").agg(F.min("a").alias("cls"), F.count(F.lit(1)).alias("k"), F.first("hot").alias("hot"), F.first("n").alias("n"))
        .join(classes.select("cls", "least.id"), "cls"),
        "ngram-cores",
    )
    any_core = not cores.isEmpty()
    if any_core:
        core_prefixes = chosen(cores).mapInArrow(_core_prefixes(size, buckets, order), PREFIX_ROWS)
        pairs = pairs.unionByName(added_up(paired(core_prefixes).filter("kind = 0")))
    clusters = settle(components(pairs), "ngram-clusters").select(F.col("node").alias("id"), F.col("root").alias("cluster"))
    wanted = classes.select(F.col("cls").alias("node"), "least.id").join(clusters.select(F.col("id").alias("node")), "node", "left_semi")
    sets = chosen(wanted).mapInArrow(_arranged(size, order, False), SETS)
    if any_core:
        in_cluster = cores.select("core", "id").join(clusters.select(F.col("id").alias("core")), "core", "left_semi")
        sets = sets.unionByName(chosen(in_cluster).mapInArrow(_arranged(size, order, True), SETS))
    sets = settle(sets.join(clusters, "id"), "ngram-sets")
    sizes = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("tokens")).alias("bytes"))
    links = _verified(sets.join(sizes, "cluster"), num, den, text_bytes_all)
    if any_core:
        # a core that links, with itself or another, joins all its sets
        ends = links.select(F.explode(F.array("a", "b")).alias("core")).distinct()
        itself = cores.filter((F.col("k") > 1) & (F.col("hot") * den >= (2 * F.col("n") - F.col("hot")) * num))
        linking = settle(
            itself.select("core", "k").unionByName(cores.select("core", "k").join(ends, "core", "left_semi")).distinct(),
            "ngram-linking",
        )
        stars = join_groups(in_core.select("a", "core"), linking, ["core"], "k", classes.count())
        links = links.unionByName(stars.select("a", F.col("core").alias("b")))
    roots = components(links).select(F.col("node").alias("cls"), "root")
    order.unpersist()

    named = settle(classes.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "ngram-roots")
    groups = settle(
        named.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("classes")), "ngram-least"
    )
    told = settle(join_groups(named, groups, ["root"], "classes", named.count()), "ngram-told")
    linked = join_groups(signed.filter("n > 0"), told.select("cls", "n", "k", "component"), ["cls", "n"], "k", signed.count())
    alone = signed.filter("n = 0").withColumn("component", F.struct("id", "tie"))
    columns = ["id", "tie", "n", "component"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def linked_groups(
    docs: DataFrame,
    size: int = 3,
    num: int = 9,
    den: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Documents link when ``den * |intersection| >= num * |union|`` of their
    sets of ``size``-word shingles (words in lower case for A to Z).
    """
    out = linked_rows(keyed_rows(docs, id_col, text_col), size, num, den)

    def real(c: str):
        return F.when(F.col(c) == NO_ID, F.lit(None).cast("long")).otherwise(F.col(c))

    return out.select(
        real("id").alias(id_col), F.col("n").alias("n_shingles"), real("component.id").alias("component_id")
    )


def one_of_each_group(
    docs: DataFrame, size: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` less near duplicates: of linked documents the one with the smallest id stays.

    Of documents with one id (or none) the one with the smaller hash of its
    text counts as the smaller; of fully repeated rows one stays. Only rows
    that may go are shuffled; a bit set of their ids lets the others pass.
    """
    rows = keyed_rows(docs, id_col, text_col, F.struct(*docs.columns).alias("kept"))
    groups = settle(linked_rows(rows, size, num, den), "ngram-groups")
    keys = ["id", "tie"]
    gone = groups.filter(F.struct(*keys) != F.col("component")).select(*keys).distinct()
    twice = groups.groupBy(*keys).count().filter("count > 1").select(*keys)
    marks = settle(gone.withColumn("gone", F.lit(True)).unionByName(twice.withColumn("gone", F.lit(False))), "ngram-marks")
    bits = power_of_two(16 * marks.count(), 1 << 16, MAX_BITS)
    marked = settle(bit_set(marks.select(position(F.col("id"), bits).alias("p")), "p"), "ngram-marked")
    tested = with_test(rows.withColumn("p", position(F.col("id"), bits)), "p", marked, "marked").drop("p", "text")
    some = tested.filter("marked").join(marks.filter("gone"), keys, "left_anti")
    again = some.join(marks.filter("NOT gone"), keys, "left_semi").dropDuplicates(keys)
    once = some.join(marks.filter("NOT gone"), keys, "left_anti")
    return (
        tested.filter("NOT marked").select("kept").unionByName(once.select("kept")).unionByName(again.select("kept"))
    ).select("kept.*")
