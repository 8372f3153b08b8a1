"""Removal of word windows that occur earlier, by Rabin-Karp hashes.

Every window of ``size`` consecutive words of every text has a 64-bit
Rabin-Karp hash. A first Spark job deals the hashes, packed as arrays with
their positions, to buckets (about a million windows in each, so their
number grows with the text), and each bucket counts its hashes; a window
whose hash also starts earlier (smaller id, or the same text and an earlier
start) is marked. Windows that repeat within one batch of a task are marked
on the spot, and only the first goes on; so a passage held by a third of
all texts reaches its bucket once for each batch, not once for each text.

A second job joins the marks with the texts. Only texts that may have a mark
are shuffled: a bit set of the marked ids (bounded size) lets all others
pass straight on. Overlapping marked windows merge into maximal intervals;
words in an interval are removed, the kept ones are joined by one blank.

Defined results: a null text has no words and an empty kept text; a text of
fewer than ``size`` words loses none; ids must be integers; a null id counts
as smaller than all others; rows with one id (or none) and different texts
are documents of their own, in the order of a hash of their texts; fully
repeated rows are one document, so they don't remove each other's words.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bitmaps import MAX_BITS, bit_set, position, with_test
from tripflow.llm.common import keyed_rows, power_of_two, settle
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
from tripflow.llm.worker import lean

# Windows that one bucket should hold; bytes of text that a word takes at least.
BUCKET_WINDOWS, WORD_BYTES = 1_000_000, 6
# Bytes of text that a task hashes at once.
PART = 1 << 23

# one row for each batch and bucket; windows marked on the spot have a bucket below 0, by their id
PACKED = "bucket int, n int, hash binary, id binary, tie binary, start binary"
# marked windows, packed by a hash of their id
MARKED = "part int, n int, id binary, tie binary, start binary"


def bucket_count(total_bytes: int) -> int:
    """Buckets for so many bytes of text."""
    return max(1, min((1 << 31) - 1, total_bytes // (BUCKET_WINDOWS * WORD_BYTES) + 1))


def _dealt(hashes: np.ndarray, count: int) -> np.ndarray:
    """Numbers below ``count``, in the narrowest kind that sorts fast."""
    return (mix(hashes) % np.uint64(count)).astype(np.uint16 if count <= 1 << 16 else np.uint32)


def _parts(ids: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` parts an id belongs to."""
    return _dealt(ids.view(np.uint64), count)


def _packed(key: np.ndarray, ids: np.ndarray, ties: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """(key, rows, number, ids, ties, starts) of each key that occurs, the last three compressed."""
    order = np.argsort(key, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(key[order].astype(np.int64), prepend=-1)), len(order)).tolist()
    for lo, hi in zip(edges, edges[1:], strict=False):
        cut = order[lo:hi]
        yield (
            int(key[cut[0]]),
            cut,
            len(cut),
            squeeze(np.diff(ids[cut], prepend=np.int64(0))),
            squeeze(ties[cut]) if ties[cut].any() else b"",
            squeeze(np.diff(starts[cut], prepend=np.int32(0))),
        )


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids, ties and starts of packed rows."""
    ids, ties, starts = [], [], []
    for r in table.select(["n", "id", "tie", "start"]).to_pylist():
        ids.append(np.cumsum(spread(r["id"], np.int64, r["n"]), dtype=np.int64))
        ties.append(spread(r["tie"], np.int64, r["n"]) if r["tie"] else np.zeros(r["n"], dtype=np.int64))
        starts.append(np.cumsum(spread(r["start"], np.int32, r["n"]), dtype=np.int32))
    return np.concatenate(ids), np.concatenate(ties), np.concatenate(starts)


def _repeats(hashes: np.ndarray, ids: np.ndarray, ties: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which entries have an equal hash with a smaller (id, tie, start)."""
    marked = np.zeros(len(hashes), dtype=bool)
    order = np.argsort(hashes)
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    some = order[twice]
    some = some[np.lexsort((starts[some], ties[some], ids[some], hashes[some]))]
    h, i, t, s = hashes[some], ids[some], ties[some], starts[some]
    lead = np.concatenate([[True], h[1:] != h[:-1]])
    first = np.maximum.accumulate(np.where(lead, np.arange(len(some)), 0))
    marked[some] = (i != i[first]) | (t != t[first]) | (s != s[first])
    return marked


def _ids(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _pack(size: int, buckets: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = byte_symbols(lower=False)
        names = ["bucket", "n", "hash", "id", "tie", "start"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        for whole in batches:
            for batch in parts(whole, 2, PART):
                data, offsets = text_bytes(batch.column(2))
                begin, end, first = word_spans(data, offsets)
                words = span_hashes(symbols[data], begin, end)
                del begin, end
                at = windows(first, size)
                if not len(at):
                    continue
                hashes = span_hashes(words, at, at + size)
                text = np.searchsorted(first, at, side="right") - 1
                ids, ties = _ids(batch, 0)[text], _ids(batch, 1)[text]
                starts = (at - first[text]).astype(np.int32)
                again = _repeats(hashes, ids, ties, starts)
                rows: list[tuple] = []
                if again.any():
                    done = ids[again], ties[again], starts[again]
                    for k, _, n, *blobs in _packed(_parts(done[0], buckets), *done):
                        rows.append((-1 - k, n, b"", *blobs))
                    hashes, ids, ties, starts = hashes[~again], ids[~again], ties[~again], starts[~again]
                # the bucket comes from other bits than those that the hash compares first
                bucket = _dealt(hashes ^ np.uint64(0x5851F42D4C957F2D), buckets)
                for b, cut, n, *blobs in _packed(bucket, ids, ties, starts):
                    rows.append((b, n, hashes[cut].tobytes(), *blobs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                )

    return run


def _mark(buckets: int):
    @lean
    def run(table: pa.Table) -> pa.Table:
        """The marked windows of one bucket."""
        names = ["part", "n", "id", "tie", "start"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            part = pa.array(np.full(table.num_rows, -1 - bucket), pa.int32())
            return pa.Table.from_arrays([part, *(table.column(k) for k in names[1:])], names=names)
        ids, ties, starts = _unpacked(table)
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("hash").to_pylist()])
        again = _repeats(hashes, ids, ties, starts)
        ids, ties, starts = ids[again], ties[again], starts[again]
        order = np.lexsort((starts, ties, ids))
        ids, ties, starts = ids[order], ties[order], starts[order]
        rows = [(k, n, *blobs) for k, _, n, *blobs in _packed(_parts(ids, buckets), ids, ties, starts)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=names)

    return run


@lean
def _by_id(table: pa.Table) -> pa.Table:
    """One row for each document of a part, with its marked starts."""
    ids, ties, starts = _unpacked(table)
    order = np.lexsort((starts, ties, ids))
    ids, ties, starts = ids[order], ties[order], starts[order]
    edges = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])]))
    blobs = [x.astype("<i4").tobytes() for x in np.split(starts, edges[1:])]
    return pa.table({"id": pa.array(ids[edges]), "tie": pa.array(ties[edges]), "starts": pa.array(blobs, pa.binary())})


def marked_windows(rows: DataFrame, size: int = 20) -> DataFrame:
    """Rows (id, tie, starts) of rows (id, tie, text).

    ``starts`` has the first words (int32 array as bytes) of a document's
    windows that start earlier too.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(total)
    packed = rows.select("id", "tie", "text").mapInArrow(_pack(size, buckets), PACKED)
    marked = packed.groupBy("bucket").applyInArrow(_mark(buckets), MARKED)
    return marked.groupBy("part").applyInArrow(_by_id, "id long, tie long, starts binary")


def _remove(size: int, names: list[str]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, 0, PART):
                texts, marks = batch.column(0), batch.column(1)
                n_words, n_removed, kept, spans = [], [], [], []
                for text, starts in zip(texts, marks, strict=True):
                    words = (text.as_py() or "").encode().split()
                    n_words.append(len(words))
                    marked = starts.as_py()
                    if not marked:
                        n_removed.append(0)
                        kept.append(b" ".join(words))
                        spans.append([])
                        continue
                    edge = np.zeros(len(words) + 1, dtype=np.int32)
                    at = np.unique(np.frombuffer(marked, dtype="<i4"))
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + size, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    step = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in step.reshape(-1, 2)])
                    n_removed.append(int(gone.sum()))
                    kept.append(b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[2:],
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array([k.decode() for k in kept], pa.string()),
                    ],
                    names=[*names, "n_words", "n_removed", "spans", "kept_text"],
                )

    return run


def remove_repeats(
    docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, spans (word intervals), kept_text."""
    rows = keyed_rows(docs, id_col, text_col, F.col(id_col).alias("_kept_id"))
    marks = settle(marked_windows(rows, size), "substring-marks")
    bits = power_of_two(16 * marks.count(), 1 << 16, MAX_BITS)
    marked_ids = settle(bit_set(marks.select(position(F.col("id"), bits).alias("p")), "p"), "substring-marked-ids")
    tested = with_test(rows.withColumn("_p", position(F.col("id"), bits)), "_p", marked_ids, "_marked")
    some = tested.filter("_marked").join(marks, ["id", "tie"], "left").select("text", "starts", "_kept_id")
    none = tested.filter("NOT _marked").select("text", F.lit(None).cast("binary").alias("starts"), "_kept_id")
    both = none.unionByName(some)
    kind = docs.schema[id_col].dataType.simpleString()
    return both.mapInArrow(
        _remove(size, [id_col]),
        f"`{id_col}` {kind}, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept_text string",
    )
