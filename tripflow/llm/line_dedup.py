"""Removal of lines that resemble an earlier line: an exact set-similarity join.

A line is the set of its distinct words (A to Z in lower case). Two lines
match if the Jaccard similarity of their sets is ``num / den`` at least; a
line goes if any line before it (smaller id, or same text and further up)
matches it, judged on the input.

1. One scan counts the words of all lines in a table of fixed size, which
   gives the words one global order, rare ones first.
2. A second scan deals each line to the words of its prefix (the first
   ``n - ceil(t * n) + 1`` in that order; matching lines share one of them),
   packed as arrays by word. Equal lines within a batch are settled on the
   spot, so a line that a third of all texts hold is sent once a batch.
   Where a word's lines meet, equal sets are settled too, and of the rest
   each line gets its likeliest partner, of those that pass the length
   filter, the positional filter and a parity sketch that bounds the
   difference of the sets (about a bit for each word). All these filters
   are lossless.
3. A scan fetches the word sets of the lines in question, and the pairs are
   verified exactly. For lines of which no partner so far was right, and which
   have more, the words' lines meet once more, now with their word sets, so
   that all partners are verified where they meet; each line that has a right
   one comes out once a word, whatever the number of its partners.
4. Texts that lose a line are joined with the marks; a bit set of bounded
   size lets all others pass without a shuffle.

Words are compared by 64-bit hashes.

Defined results: lines of fewer than ``min_words`` distinct words (by
default, lines without a word) always stay and match nothing; a null text has
no lines and stays null; an empty text is one empty line; ids must be
integers; a null id counts as smaller than all others; rows with one id (or
none) and different texts are documents of their own, in the order of a hash
of their texts; fully repeated rows are one document, so they don't remove
each other's lines. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bitmaps import MAX_BITS, bit_set, position, with_test
from tripflow.llm.common import keyed_rows, power_of_two, settle
from tripflow.llm.textnp import mix, parts, runs, spread, squeeze, text_bytes, word_hashes, word_spans
from tripflow.llm.worker import lean

WIDTH, SLICES = 1 << 22, 256
# 64-bit words of the longest sketch.
WIDEST = 16
PART = 1 << 22
BUCKET_BYTES = 8 << 20
# Lines of a word that are paired at once; a side of a block of larger ones.
SMALL, SIDE = 512, 512
# Partners that a line without a likely one gets at first.
FIRST = 8
LINE_BITS = 1 << 26
# 64-bit words of the sketches that are made where word sets meet; pairs of sets compared at once.
FINE, PAIRS = 16, 1 << 15
# Entries whose word sets are held at once, but for a word of more; how much smaller the buckets of word sets are.
UNIT, FINER = 1 << 14, 16
# Words of the lines that are held until they are dealt with their word sets.
HELD = 1 << 19

# Words that share the 32 bits of ``token`` only make more candidates. Sets that agree in ``sig``, ``parity`` (64 bits
# of it) and ``n`` are equal. ``parity`` has ``sketch_size(n)`` numbers for each entry.
COLUMNS = (
    ("token", np.uint32),
    ("sig", np.uint32),
    ("parity", np.uint64),
    ("id", np.int64),
    ("tie", np.int64),
    ("line", np.int32),
    ("n", np.int32),
    ("at", np.int32),
)
RAW = ("token", "sig", "parity")
PACKED = "bucket int, k int, " + ", ".join(f"{name} binary" for name, _ in COLUMNS) + ", sets binary"
# what names a line: two numbers of its document, and its own
LINE = ("id", "tie", "line")
Y, X = ([f"{side}_{name}" for name in LINE] for side in "yx")
FOUND = "y_id long, y_tie long, y_line int, x_id long, x_tie long, x_line int, more boolean, word long, far int"


def _numbers(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def line_key(ids: np.ndarray, ties: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Position of a line in a bit set of lines."""
    with np.errstate(over="ignore"):
        h = mix((ids + ties).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + lines.astype(np.uint64))
    return (h & np.uint64(LINE_BITS - 1)).astype(np.int64)


def sketch_size(n: np.ndarray) -> np.ndarray:
    """64-bit words of the sketch of a line of ``n`` words: a power of two, about a bit for each word."""
    size = np.ones(len(n), dtype=np.int64)
    for k in range(WIDEST.bit_length() - 1):
        size[n > 64 << k] = 2 << k
    return size


def sketches(words: np.ndarray, begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parity sketches of lines, one after the other; where each begins, and their sizes.

    A word flips the bit that its hash names. So two sketches of one size
    differ in no more bits than the sets in words. A sketch whose halves are
    added by exclusive or is the sketch of half the size.
    """
    size = sketch_size(n)
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint64)
    bit = words & (np.repeat(size, n) * 64 - 1).astype(np.uint64)
    np.bitwise_xor.at(
        out, np.repeat(first, n) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))
    )
    return out, first, size


def folded(sketch: np.ndarray, first: np.ndarray, size: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each sketch size, the rows that have it at least (as numbers in a table), and the table."""
    out, width = {}, WIDEST
    rows, table = np.empty(0, dtype=np.int64), np.empty((0, width), dtype=np.uint64)
    while True:
        own = np.flatnonzero(size == width)
        rows = np.concatenate([rows, own])
        table = np.concatenate([table, sketch[first[own][:, None] + np.arange(width)]])
        at = np.full(len(size), -1, dtype=np.int64)
        at[rows] = np.arange(len(rows))
        out[width] = (at, table)
        if width == 1:
            return out
        width //= 2
        table = table[:, :width] ^ table[:, width:]


def ordered(*keys: np.ndarray) -> np.ndarray:
    """The order of rows by these whole numbers, the first key first; equal rows come in any order."""
    spans, bits = [], 0
    for key in keys:
        low, high = (int(key.min()), int(key.max())) if len(key) else (0, 0)
        spans.append((low, (high - low).bit_length()))
        bits += spans[-1][1]
    if bits > 64:
        return np.lexsort(keys[::-1])
    packed = np.zeros(len(keys[0]), dtype=np.uint64)
    for key, (low, width) in zip(keys, spans, strict=True):
        # differences wrap, so that they are right for any two 64-bit numbers
        if width:
            with np.errstate(over="ignore"):
                shift = key.astype(np.int64).view(np.uint64) - np.uint64(low % (1 << 64))
            packed = (packed << np.uint64(width) if width < 64 else packed) | shift
    return np.argsort(packed)


def word_token(words: np.ndarray) -> np.ndarray:
    """The part of a word's hash that its prefixes are dealt with."""
    return (words >> np.uint64(32)).astype(np.uint32)


def word_key(tokens: np.ndarray) -> np.ndarray:
    """Position of a token, which is a hash, in a bit set of words."""
    return tokens.astype(np.int64) & (LINE_BITS - 1)


def _heads(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, int)


class Lines:
    """The distinct words of the lines of a batch, line by line.

    With ``wanted``, a bit set of lines, of those; with ``tokens``, a bit set of words, of lines that have one of them.
    """

    def __init__(
        self,
        batch: pa.RecordBatch,
        rank: np.ndarray | None = None,
        wanted: np.ndarray | None = None,
        tokens: np.ndarray | None = None,
    ):
        data, offsets = text_bytes(batch.column(2))
        begin, end, first = word_spans(data, offsets)
        breaks = np.flatnonzero(data == 0x0A)
        # empty texts share an offset; the last of them has the words
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        line = np.cumsum(np.bincount(np.searchsorted(begin, breaks), minlength=len(begin) + 1)[: len(begin)]) + text
        ids, ties = _numbers(batch, 0), _numbers(batch, 1)
        before = np.searchsorted(breaks, offsets)  # line breaks before each text

        def only(chosen: np.ndarray) -> np.ndarray:
            """Which words are in the lines ``chosen``, of those that have words."""
            return np.repeat(chosen, np.diff(np.append(_heads(line), len(line))))

        if wanted is not None:
            lead = _heads(line)
            number = line[lead] - text[lead] - before[text[lead]]
            inside = only(_bits(wanted, line_key(ids[text[lead]], ties[text[lead]], number)))
            begin, end, text, line = begin[inside], end[inside], text[inside], line[inside]
        words = word_hashes(data, begin, end)
        if tokens is not None and len(line):
            inside = only(np.logical_or.reduceat(_bits(tokens, word_key(word_token(words))), _heads(line)))
            words, text, line = words[inside], text[inside], line[inside]
        order = np.zeros(len(words), dtype=np.uint8) if rank is None else rank[words & np.uint64(WIDTH - 1)]
        if len(line) and int(line[-1]) < 1 << 20:
            key = line.astype(np.uint64) << np.uint64(44)
            key |= order.astype(np.uint64) << np.uint64(36)
            key |= words >> np.uint64(28)
            at = np.argsort(key)
        else:
            at = np.lexsort((words, order, line))
        words = words[at]  # lines and texts ascend already
        new = np.ones(len(at), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (words[1:] != words[:-1])
        line, self.words, text = line[new], words[new], text[new]
        self.begin = _heads(line)
        self.n = np.diff(np.append(self.begin, len(line)))
        self.text = text[self.begin]
        self.line = (line[self.begin] - self.text - before[self.text]).astype(np.int32)
        self.ids, self.ties = (x[self.text] if len(self.text) else np.empty(0, np.int64) for x in (ids, ties))

    def keep(self, chosen: np.ndarray) -> None:
        """Go on with some of the lines."""
        inside = np.repeat(chosen, self.n)
        self.words = self.words[inside]
        for name in ("n", "text", "line", "ids", "ties"):
            setattr(self, name, getattr(self, name)[chosen])
        self.begin = np.cumsum(self.n) - self.n

    def add(self, others: list[Lines]) -> None:
        """Take in lines of other batches."""
        for name in ("words", "n", "text", "line", "ids", "ties"):
            setattr(self, name, np.concatenate([getattr(x, name) for x in (self, *others)]))
        self.begin = np.cumsum(self.n) - self.n


def _count():
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros(WIDTH, dtype=np.int32), 0
        for whole in batches:
            for batch in parts(whole, 2, PART):
                # every occurrence counts; which of two words is rarer hardly depends on repeats in a line
                data, offsets = text_bytes(batch.column(2))
                begin, end, _ = word_spans(data, offsets)
                words = word_hashes(data, begin, end)
                np.add.at(counts, words & np.uint64(WIDTH - 1), np.int32(1))
                size += len(data)
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(SLICES, dtype=np.int32)),
                    pa.array([squeeze(x) for x in np.split(counts, SLICES)], pa.binary()),
                    pa.array([size] + [0] * (SLICES - 1), pa.int64()),
                ],
                names=["slice", "counts", "size"],
            )

    return run


@lean
def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(WIDTH // SLICES, dtype=np.int64)
    for blob in table.column("counts").to_pylist():
        total += spread(blob, np.int32, len(total))
    rank = np.minimum(255, 4 * np.log2(total + 1.0)).astype(np.uint8)
    size = sum(table.column("size").to_pylist())
    return pa.table({"slice": table.column("slice")[:1], "rank": pa.array([rank.tobytes()], pa.binary()), "size": [size]})


def word_ranks(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Rarity class of each cell of the count table (more for commoner words), and the bytes of all texts."""
    added = (
        rows.mapInArrow(_count(), "slice int, counts binary, size long")
        .groupBy("slice")
        .applyInArrow(_add, "slice int, rank binary, size long")
    )
    ranks, size = np.zeros(WIDTH, dtype=np.uint8), 0
    for r in added.collect():  # SLICES rows, of WIDTH bytes together
        lo = r["slice"] * (WIDTH // SLICES)
        ranks[lo : lo + WIDTH // SLICES] = np.frombuffer(r["rank"], dtype=np.uint8)
        size += r["size"]
    return ranks, size


def _pack(buckets: int, num: int, den: int, min_words: int, ranks, only):
    """Prefixes by word; with ``only``, a bit set of words, those and no others, with the lines' word sets."""

    def dealt(x: Lines, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place in its line, and whether the line is dealt to it."""
        prefix = x.n - -(-num * x.n // den) + 1
        place = np.arange(len(x.words)) - np.repeat(x.begin, x.n)
        inside = place < np.repeat(prefix, x.n)
        if wanted is not None:
            inside &= _bits(wanted, word_key(word_token(x.words)))
        return place, inside

    def lines(batches: Iterator[pa.RecordBatch], rank: np.ndarray, wanted: np.ndarray | None) -> Iterator[Lines]:
        """The lines to deal; of many batches together where few lines are wanted."""
        held: list[Lines] = []
        for whole in batches:
            for batch in parts(whole, 2, PART):
                x = Lines(batch, rank, tokens=wanted)
                x.keep(x.n >= min_words)
                if wanted is not None and len(x.n):
                    x.keep(np.logical_or.reduceat(dealt(x, wanted)[1], x.begin))
                if wanted is None and len(x.n):
                    yield x
                elif len(x.n):
                    held.append(x)
                if sum(len(h.words) for h in held) > HELD:
                    held[0].add(held[1:])
                    yield held[0]
                    held = []
        if held:
            held[0].add(held[1:])
            yield held[0]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        wanted = None if only is None else only.value
        names = [name for name, _ in COLUMNS]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * (len(COLUMNS) + 1)]
        for x in lines(batches, rank, wanted):
            sig = (np.add.reduceat(mix(x.words), x.begin) >> np.uint64(32)).astype(np.uint32)
            parity, first_of, size_of = sketches(x.words, x.begin, x.n)
            base = np.bitwise_xor.reduceat(parity, first_of)
            # equal sets of this batch: the first goes on, marks for the others
            at = np.lexsort((x.line, x.ties, x.ids, x.n, base, sig))
            same = np.zeros(len(at), dtype=bool)
            for values in (sig, base, x.n):
                same[1:] = (same[1:] if values is not sig else True) & (values[at][1:] == values[at][:-1])
            later = np.zeros(len(at), dtype=bool)
            later[at[same]] = True
            out: dict[str, list] = {k: [] for k in ("bucket", "k", *names, "sets")}
            if wanted is None and later.any():
                first = at[np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))]
                other = np.zeros(len(at), dtype=bool)
                for value in (x.ids, x.ties, x.line):
                    other[at] |= value[at] != value[first]
                gone = np.flatnonzero(later & other)
                out["bucket"].append(-1 - (int(x.ids[0]) + int(x.line[0])) % buckets)
                out["k"].append(len(gone))
                for name, kind in COLUMNS:
                    value = {"id": x.ids, "tie": x.ties, "line": x.line}.get(name)
                    out[name].append(b"" if value is None else value[gone].astype(kind).tobytes())
                out["sets"].append(b"")
            x_first, x_size, x_sig = first_of[~later], size_of[~later], sig[~later]
            x.keep(~later)
            place, inside = dealt(x, wanted)
            row = np.repeat(np.arange(len(x.n)), x.n)[inside]
            token = word_token(x.words[inside])
            bucket = mix(token.astype(np.uint64) + np.uint64(1)) % np.uint64(buckets)
            bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
            values = (token, x_sig[row], row, x.ids[row], x.ties[row], x.line[row], x.n[row], place[inside])
            by = np.argsort(bucket, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(bucket[by].astype(np.int64), prepend=-1)), len(by)).tolist()
            for lo, hi in zip(edges, edges[1:], strict=False):
                cut = by[lo:hi]
                out["bucket"].append(int(bucket[cut[0]]))
                out["k"].append(len(cut))
                for (name, kind), value in zip(COLUMNS, values, strict=True):
                    v = value[cut].astype(kind) if name != "parity" else parity[runs(x_first, x_size, value[cut])]
                    if name in ("id", "line"):
                        v = np.diff(v, prepend=kind(0))
                    out[name].append(v.tobytes() if name in RAW else squeeze(v))
                whole_sets = b"" if wanted is None else x.words[runs(x.begin, x.n, row[cut])].tobytes()
                out["sets"].append(whole_sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)], names=list(out)
            )

    return run


def _bits(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Met:
    """The lines of a bucket's words: entries in the order of (token, id, tie, line), equal sets of a word once."""

    def __init__(self, table: pa.Table, num: int, den: int):
        self.num, self.den = num, den
        v: dict[str, list] = {name: [] for name, _ in COLUMNS}
        sets = []
        for r in table.to_pylist():
            sets.append(np.frombuffer(r["sets"], np.uint64))
            for name, kind in COLUMNS:
                if name in RAW:
                    v[name].append(np.frombuffer(r[name], kind))
                else:
                    got = spread(r[name], kind, r["k"])
                    v[name].append(np.cumsum(got, dtype=kind) if name in ("id", "line") else got)
        v = {name: np.concatenate(x) for name, x in v.items()}
        self.sets = np.concatenate(sets)
        sketch = v["parity"]
        v["size"] = sketch_size(v["n"])
        v["first"] = np.cumsum(v["size"]) - v["size"]
        v["own"] = np.cumsum(v["n"], dtype=np.int64) - v["n"]
        v["parity"] = np.bitwise_xor.reduceat(sketch, v["first"])
        at = ordered(v["id"], v["tie"], v["line"])
        # positions below the tokens keep that order
        key = (v["token"][at].astype(np.uint64) << np.uint64(32)) | np.arange(len(at), dtype=np.uint64)
        at = at[np.sort(key) & np.uint64(0xFFFFFFFF)]
        v = {name: x[at] for name, x in v.items()}
        # Equal sets of a word side by side, in that order. Other sets of the same hash may part them, which
        # only makes candidates.
        low = np.uint64((1 << len(at).bit_length()) - 1)
        key = mix(v["parity"] ^ mix((v["token"].astype(np.uint64) << np.uint64(32)) | v["sig"]))
        key = (mix(key + v["n"].astype(np.uint64)) & ~low) | np.arange(len(at), dtype=np.uint64)
        by = (np.sort(key) & low).astype(np.int64)
        same = np.zeros(len(at), dtype=bool)
        same[1:] = True
        for name in ("token", "sig", "parity", "n"):
            values = v[name][by]
            same[1:] &= values[1:] == values[:-1]
        lead = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))][same]
        later = by[same]
        other = np.zeros(len(later), dtype=bool)
        for name in LINE:
            other |= v[name][later] != v[name][lead]
        # every line is dealt to its rarest word, where its equals are
        gone = later[other & (v["at"][later] == 0)]
        self.equal = {name: v[name][gone] for name in LINE}
        stay = np.ones(len(at), dtype=bool)
        stay[later] = False
        v = {name: x[stay] for name, x in v.items()}
        v["n"], v["at"] = v["n"].astype(np.int64), v["at"].astype(np.int64)
        self.v = v
        self.folded = folded(sketch, v["first"], v["size"])
        self.begin = _heads(v["token"])
        self.many = np.diff(np.append(self.begin, len(v["token"])))

    def possible(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that may match, and in how many bits their sketches differ."""
        v, num, den = self.v, self.num, self.den
        n, m = v["n"][i], v["n"][j]
        some = np.flatnonzero(den * np.minimum(n, m) >= num * np.maximum(n, m))
        i, j, n, m = i[some], j[some], n[some], m[some]
        p, q = v["at"][i], v["at"][j]
        least = -(-num * (n + m) // (num + den))
        ok = np.flatnonzero(np.minimum(p, q) + 1 + np.minimum(n - p - 1, m - q - 1) >= least)
        i, j, most = i[ok], j[ok], (n + m - 2 * least)[ok]
        far = np.zeros(len(i), dtype=np.int64)
        level = np.minimum(v["size"][i], v["size"][j])
        for width, (at, table) in self.folded.items():
            some = np.flatnonzero(level == width)
            if len(some):
                far[some] = np.bitwise_count(table[at[i[some]]] ^ table[at[j[some]]]).sum(axis=1, dtype=np.int64)
        ok = far <= most
        i, j, far = i[ok], j[ok], far[ok]
        other = np.zeros(len(i), dtype=bool)
        for name in LINE:
            other |= v[name][i] != v[name][j]
        return i[other], j[other], far[other]

    def small_words(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (earlier, later) of the words of at most ``SMALL`` lines, in the order of (later, earlier)."""
        small = (self.many > 1) & (self.many <= SMALL)
        ys = runs(self.begin, self.many, np.flatnonzero(small))
        first = np.repeat(self.begin[small], self.many[small])
        pairs = np.cumsum(ys - first)
        lo = 0
        while lo < len(ys):
            done = int(pairs[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(pairs, done + PAIRS, side="right")))
            n = ys[lo:hi] - first[lo:hi]
            yield runs(first[lo:hi], n, np.arange(hi - lo)), np.repeat(ys[lo:hi], n)
            lo = hi

    def large_words(self) -> Iterator[tuple[int, int]]:
        """First entry and number of lines of the other words."""
        large = self.many > SMALL
        return zip(self.begin[large].tolist(), self.many[large].tolist(), strict=True)

    def units(self, asked: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of entries, of whole words with a line in ``asked``, of about ``UNIT`` entries."""
        busy = (np.add.reduceat(asked, self.begin, dtype=np.int64) > 0) & (self.many > 1)
        lo = hi = 0
        for start, m, wanted in zip(self.begin.tolist(), self.many.tolist(), busy.tolist(), strict=True):
            if not wanted or hi - lo > UNIT:
                if hi > lo:
                    yield lo, hi
                lo = hi = start + m
                if wanted:
                    lo = start
            hi = start + m if wanted else hi
        if hi > lo:
            yield lo, hi


class Unit:
    """Some entries with their word sets, to compare exactly."""

    def __init__(self, met: Met, lo: int, hi: int):
        self.met, self.lo = met, lo
        self.n, own = met.v["n"][lo:hi], met.v["own"][lo:hi]
        words = met.sets[runs(own, self.n, np.arange(hi - lo))]
        self.own = np.cumsum(self.n) - self.n
        self.word = np.unique(words, return_inverse=True)[1]
        self.fine = np.zeros((hi - lo, FINE), dtype=np.uint64)
        bit = mix(words) & np.uint64(64 * FINE - 1)
        row = np.repeat(np.arange(hi - lo), self.n)
        np.bitwise_xor.at(self.fine, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))

    def matches(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of entries match."""
        num, den, n = self.met.num, self.met.den, self.n
        i, j = i - self.lo, j - self.lo
        least = -(-num * (n[i] + n[j]) // (num + den))
        out = np.zeros(len(i), dtype=bool)
        for lo in range(0, len(i), PAIRS):
            a, b = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
            far = np.bitwise_count(self.fine[a] ^ self.fine[b]).sum(axis=1, dtype=np.int64)
            some = lo + np.flatnonzero(far <= n[a] + n[b] - 2 * least[lo : lo + PAIRS])
            key = []
            for k in (i[some], j[some]):
                pair = np.repeat(np.arange(len(some)), n[k])
                key.append(pair * (len(self.word) + 1) + self.word[runs(self.own, n, k)])
            key = np.sort(np.concatenate(key))
            both = key[1:][key[1:] == key[:-1]] // (len(self.word) + 1)
            out[some] = np.bincount(both, minlength=len(some)) >= least[some]
        return out


def _nearest(i: np.ndarray, j: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line ``j`` the ``FIRST`` nearest partners, in the order of (j, d, i)."""
    by = ordered(j, d, i)
    i, j, d = i[by], j[by], d[by]
    head = np.concatenate([[True], j[1:] != j[:-1]]) if len(j) else np.empty(0, dtype=bool)
    place = np.arange(len(j)) - np.maximum.accumulate(np.where(head, np.arange(len(j)), 0))
    keep = place < FIRST
    return i[keep], j[keep], d[keep]


def _partners(num: int, den: int):
    """Equal lines to remove (x_line null), and possible partners of the others.

    Each line gets, of a word's, the partner of the nearest sketch, or if that isn't a likely one
    the ``FIRST`` nearest (``more``: there are others).
    """

    @lean
    def run(table: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.int32()] * 2 + [pa.bool_(), pa.int64(), pa.int32()]
        names = [c.split(" ")[0] for c in FOUND.split(", ")]
        if table.column("bucket")[0].as_py() < 0:
            which = [
                pa.array(np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()]))
                for name, kind in COLUMNS
                if name in LINE
            ]
            nothing = [pa.nulls(len(which[0]), k) for k in kinds[3:]]
            return pa.Table.from_arrays([*which, *nothing], names=names)
        met = Met(table, num, den)
        v = met.v
        picked: list[tuple] = []

        def pick(i: np.ndarray, j: np.ndarray, d: np.ndarray, partners: np.ndarray | None = None) -> None:
            """Keep what is asked for of the partners ``i`` of lines ``j``, in the order of (j, d, i).

            ``partners`` has the number of all partners of each line, if not all are given.
            """
            head = np.concatenate([[True], j[1:] != j[:-1]])
            lead = np.maximum.accumulate(np.where(head, np.arange(len(j)), 0))
            if partners is None:
                partners = np.diff(np.append(np.flatnonzero(head), len(j)))[np.cumsum(head) - 1]
            most = np.where(8 * d[lead] <= v["n"][j], 1, FIRST)
            keep = np.arange(len(j)) - lead < most
            picked.append((i[keep], j[keep], d[keep], (partners > most)[keep]))

        for a, b in met.small_words():
            i, j, d = met.possible(a, b)
            if len(j):
                by = ordered(j, d, i)
                pick(i[by], j[by], d[by])
        for start, m in met.large_words():
            for lo in range(0, m, SIDE):
                ys = np.arange(start + lo, start + min(m, lo + SIDE))
                near = np.zeros(len(ys), dtype=np.int64)  # partners whose sketch hardly differs
                partners = np.zeros(len(ys), dtype=np.int64)
                best = tuple(np.empty(0, dtype=np.int64) for _ in range(3))
                for x0 in range(0, lo + SIDE, SIDE):
                    # who has two such needs no others at first
                    open_ = np.flatnonzero(near < 2)
                    if not len(open_):
                        break
                    xs = np.arange(start + x0, start + min(m, x0 + SIDE))
                    b = np.repeat(ys[open_], len(xs))
                    a = np.tile(xs, len(open_))
                    earlier = a < b
                    found = met.possible(a[earlier], b[earlier])
                    partners += np.bincount(found[1] - ys[0], minlength=len(ys))
                    likely = found[1][8 * found[2] <= v["n"][found[1]]]
                    near += np.bincount(likely - ys[0], minlength=len(ys))
                    best = _nearest(*(np.concatenate(x) for x in zip(best, found, strict=True)))
                if len(best[1]):
                    pick(*best, partners[best[1] - ys[0]])
        empty = np.empty(0, dtype=np.int64)
        i, j, d = (np.concatenate([p[k] for p in picked]) if picked else empty for k in range(3))
        more = np.concatenate([p[3] for p in picked]) if picked else empty.astype(bool)
        n = len(met.equal["id"])
        y = [pa.array(np.concatenate([met.equal[name], v[name][j]])) for name in LINE]
        x = [pa.concat_arrays([pa.nulls(n, k), pa.array(v[name][i], k)]) for name, k in zip(LINE, kinds[3:], strict=False)]
        rest = [more, v["token"][j].astype(np.int64), d]
        rest = [pa.concat_arrays([pa.nulls(n, k), pa.array(r, k)]) for r, k in zip(rest, kinds[6:], strict=True)]
        return pa.Table.from_arrays([*y, *x, *rest], names=names)

    return run


def _settled_on_the_spot(num: int, den: int, pending):
    """Of the lines in ``pending`` (a bit set) those (id, tie, line) that match an earlier line, once a word."""

    @lean
    def run(table: pa.Table) -> pa.Table:
        met = Met(table, num, den)
        v = met.v
        asked = _bits(pending.value, line_key(v["id"], v["tie"], v["line"]))
        gone = np.zeros(len(asked), dtype=bool)
        many = np.repeat(met.many, met.many)
        first = np.repeat(met.begin, met.many)
        for lo, hi in met.units(asked):
            unit = Unit(met, lo, hi)
            # later lines of ``SIDE`` words or more at a time, with ``SIDE`` earlier ones of each word
            wanted = lo + np.flatnonzero(asked[lo:hi] & (np.arange(lo, hi) > first[lo:hi]))
            for at in range(0, len(wanted), SIDE):
                ys = wanted[at : at + SIDE]
                for step in range(0, int(many[ys].max()), SIDE):
                    left = ys[~gone[ys] & (first[ys] + step < ys)]
                    n = np.minimum(SIDE, left - first[left] - step)
                    a = runs(first[left] + step, n, np.arange(len(left)))
                    i, j, _ = met.possible(a, np.repeat(left, n))
                    gone[j[unit.matches(i, j)]] = True
        at = np.flatnonzero(gone)
        return pa.table({name: pa.array(v[name][at]) for name in LINE})

    return run


def _fetch(left, right):
    """The word sets of the lines in two bit sets, as rows (id, tie, line, is_x, is_y, words)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        either = left.value | right.value
        for whole in batches:
            for batch in parts(whole, 2, PART):
                x = Lines(batch, wanted=either)
                key = line_key(x.ids, x.ties, x.line)
                blobs = [w.tobytes() for w in np.split(x.words, x.begin[1:])] if len(x.n) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x.ids),
                        pa.array(x.ties),
                        pa.array(x.line),
                        pa.array(_bits(left.value, key)),
                        pa.array(_bits(right.value, key)),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=[*LINE, "is_x", "is_y", "words"],
                )

    return run


def _verify(num: int, den: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words, total = [], [], np.zeros(batch.num_rows, dtype=np.int64)
            for column in (batch.column(3), batch.column(4)):
                data, offsets = text_bytes(column)
                n = np.diff(offsets) // 8
                words.append(np.frombuffer(data.tobytes(), np.uint64))
                rows.append(np.repeat(np.arange(batch.num_rows), n))
                total += n
            row, word = np.concatenate(rows), np.concatenate(words)
            # a word of both sets comes twice
            at = np.argsort(mix(word ^ mix(row)))
            row, word = row[at], word[at]
            twice = row[1:][(row[1:] == row[:-1]) & (word[1:] == word[:-1])]
            both = np.bincount(twice, minlength=batch.num_rows)
            keep = pa.array(den * both >= num * (total - both), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in range(3)], names=list(LINE))

    return run


def _collect_bits(keys: DataFrame) -> np.ndarray:
    """A bit set of ``LINE_BITS`` positions (its size is fixed) from a column ``p``."""
    table = np.zeros(LINE_BITS // 8, dtype=np.uint8)
    for r in bit_set(keys.select((F.col("p") + 1).alias("p")), "p").toLocalIterator():
        lo = (r["bucket"] - 1) * 4096
        table[lo : lo + 4096] = np.frombuffer(r["bitmap"], dtype=np.uint8)
    return table


def _keyed(rows: DataFrame, kind: str) -> DataFrame:
    """Column ``p``: the positions of lines (id, tie, line) or words, as the tasks compute them."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
            key = line_key(*got) if kind == "line" else word_key(got[0].astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(key), pa.int64())], names=["p"])

    return rows.mapInArrow(run, "p long")


def _right(rows: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The lines (id, tie, line) of ``pairs`` that really match their partner."""
    context = rows.sparkSession.sparkContext
    bits = [context.broadcast(_collect_bits(_keyed(pairs.select(*side), "line"))) for side in (X, Y)]
    sets = settle(
        rows.mapInArrow(_fetch(*bits), "id long, tie long, line int, is_x boolean, is_y boolean, words binary"),
        "line-sets",
    )
    for b in bits:
        b.unpersist()
    x, y = (
        sets.filter(f"is_{k}").select(
            *(F.col(c).alias(f"{k}_{c}") for c in LINE), F.col("words").alias(f"{k}_words")
        )
        for k in "xy"
    )
    joined = pairs.select(*Y, *X).join(x, X).join(y, Y)
    return joined.select(*Y, "x_words", "y_words").mapInArrow(_verify(num, den), "id long, tie long, line int")


def repeated_lines(rows: DataFrame, num: int, den: int, min_words: int) -> DataFrame:
    """The lines (id, tie, line) that go, of rows (id, tie, text)."""
    spark = rows.sparkSession
    context = spark.sparkContext
    counted, total = word_ranks(rows)
    ranks = context.broadcast(counted)
    buckets = max(1, min((1 << 31) // FINER - 1, total // BUCKET_BYTES + 1))

    def meet(only, task, schema: str) -> DataFrame:
        count = buckets if only is None else buckets * FINER
        packed = rows.mapInArrow(_pack(count, num, den, min_words, ranks, only), PACKED)
        return packed.groupBy("bucket").applyInArrow(task, schema)

    found = settle(meet(None, _partners(num, den), FOUND), "line-partners")
    equal = found.filter("x_line IS NULL").select(*(F.col(f"y_{c}").alias(c) for c in LINE)).distinct()
    pairs = found.filter("x_line IS NOT NULL")
    # of each line the FIRST nearest partners
    x = F.struct("far", *X)
    best = (
        pairs.groupBy(*Y)
        .agg(F.array_sort(F.collect_set(x)).alias("xs"), F.max("more").alias("more"), F.collect_set("word").alias("words"))
        .join(equal.select(*(F.col(c).alias(f"y_{c}") for c in LINE)), Y, "left_anti")
        .withColumn("more", F.col("more") | (F.size("xs") > FIRST))
        .withColumn("x", F.explode(F.slice("xs", 1, FIRST)))
        .select(*Y, *(f"x.{c}" for c in X), "more", F.when(F.col("more"), F.col("words")).alias("words"))
    )
    best = settle(best, "line-pairs")
    sure = settle(_right(rows, best.drop("more", "words"), num, den).unionByName(equal).distinct(), "lines-gone")
    open_ = settle(
        best.filter("more").groupBy(*Y).agg(F.first("words").alias("words"))
        .join(sure.select(*(F.col(c).alias(f"y_{c}") for c in LINE)), Y, "left_anti"),
        "lines-open",
    )
    if open_.isEmpty():
        ranks.unpersist()
        return sure
    words = context.broadcast(_collect_bits(_keyed(open_.select(F.explode("words").alias("word")), "word")))
    pending = context.broadcast(_collect_bits(_keyed(open_.select(*Y), "line")))
    again = meet(words, _settled_on_the_spot(num, den, pending), "id long, tie long, line int")
    out = settle(sure.unionByName(again).distinct(), "lines-gone")
    for b in (ranks, words, pending):
        b.unpersist()
    return out


@lean
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their marked lines."""
    for batch in batches:
        n_lines, removed, kept = [], [], []
        for text, gone in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            drop = set(gone or ())
            n_lines.append(0 if text is None else text.count("\n") + 1)
            removed.append(sorted(drop))
            if drop:
                text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(2),
                pa.array(n_lines, pa.int64()),
                pa.array([len(x) for x in removed], pa.int64()),
                pa.array(removed, pa.list_(pa.int32())),
                pa.array(kept, pa.string()),
            ],
            names=["kept", "n_lines", "n_removed", "removed_lines", "kept_text"],
        )


def cleaned_rows(
    docs: DataFrame,
    num: int = 8,
    den: int = 10,
    min_words: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows (kept, n_lines, n_removed, removed_lines, kept_text); ``kept`` is a struct of the columns ``keep``.

    Lines are numbered from 0.
    """
    rows = keyed_rows(docs, id_col, text_col, F.struct(*((id_col,) if keep is None else keep)).alias("kept"))
    gone = settle(repeated_lines(rows.select("id", "tie", "text"), num, den, min_words), "lines-removed")
    by_doc = settle(gone.groupBy("id", "tie").agg(F.collect_list("line").alias("gone")), "lines-by-document")
    bits = power_of_two(16 * by_doc.count(), 1 << 16, MAX_BITS)
    marked = settle(bit_set(by_doc.select(position(F.col("id"), bits).alias("p")), "p"), "line-marked-ids")
    tested = with_test(rows.withColumn("p", position(F.col("id"), bits)), "p", marked, "marked")
    some = tested.filter("marked").join(by_doc, ["id", "tie"], "left").select("text", "gone", "kept")
    kind = rows.schema["kept"].dataType.simpleString()
    cut = some.mapInArrow(
        _cut, f"kept {kind}, n_lines long, n_removed long, removed_lines array<int>, kept_text string"
    )
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    none = tested.filter("NOT marked").select(
        "kept",
        F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<int>").alias("removed_lines"),
        F.col("text").alias("kept_text"),
    )
    return none.unionByName(cut)


def remove_lines(docs: DataFrame, **settings) -> DataFrame:
    """The id of each row with n_lines, n_removed, removed_lines, kept_text; settings as for ``cleaned_rows``."""
    return cleaned_rows(docs, **settings).select("kept.*", "n_lines", "n_removed", "removed_lines", "kept_text")
