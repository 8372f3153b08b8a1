"""Words of whole Arrow batches as numpy arrays, and hashes of words and windows.

Texts are read as the UTF-8 bytes of an Arrow column, without a Python
object for each text or word. A word's hash is a Rabin-Karp polynomial over
its bytes modulo 2^64 (each byte mapped to a fixed random number), mixed
with its length; windows of words are hashed the same way over word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Fixed value: the white space that the contracts name, as bytes.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BASE = 0x9E3779B97F4A7C15 | 1
# Bytes (or words) whose powers are held at once, few enough for a processor's cache.
RUN = 1 << 15
# Bytes of a word that are hashed eight at a time; words that are hashed at once.
LONG, WORDS = 256, 1 << 14
# Masks of the lowest bytes.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n + 1`` of each."""
    if len(_powers.get("up", ())) <= n:
        size = max(n, 2 * RUN) + 1
        with np.errstate(over="ignore"):
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``symbols[start:end]`` for each span; starts must ascend.

    Equal spans have equal hashes; the length takes part.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(starts, base + RUN)))
        last = int(ends[lo:hi].max())
        up, down = _power_tables(last - base)
        with np.errstate(over="ignore"):
            sums = np.zeros(last - base + 1, dtype=np.uint64)
            np.cumsum(symbols[base:last] * up[: last - base], out=sums[1:])
            a, b = starts[lo:hi] - base, ends[lo:hi] - base
            value = (sums[b] - sums[a]) * down[a]
            out[lo:hi] = mix(value + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        lo = hi
    return out


def _eight(chunks: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` bytes from each byte ``at``, up to eight, as one number; ``chunks`` has all bytes, eight in each."""
    cell, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
    value = chunks[cell] >> shift
    value |= (chunks[cell + 1] << (np.uint64(63) - shift)) << np.uint64(1)
    return value & _LOW[np.minimum(n, 8)]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each word, A to Z as a to z, eight at a time; other values than ``span_hashes`` gives."""
    padded = np.zeros(len(data) // 8 * 8 + 24, dtype=np.uint8)
    np.add(data, (data - np.uint8(0x41) < 26).view(np.uint8) << np.uint8(5), out=padded[: len(data)])
    out = np.empty(len(starts), dtype=np.uint64)
    for lo in range(0, len(starts), WORDS):
        out[lo : lo + WORDS] = _some_hashes(padded, starts[lo : lo + WORDS], ends[lo : lo + WORDS])
    return out


def _some_hashes(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    chunks, n = padded.view("<u8"), ends - starts
    with np.errstate(over="ignore"):
        out = mix(_eight(chunks, starts, n) + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        left, done = np.flatnonzero(n > 8), 8
        while len(left) and done < LONG:
            more = _eight(chunks, starts[left] + done, n[left] - done)
            out[left] = mix(out[left] * np.uint64(BASE) + more)
            done += 8
            left = left[n[left] > done]
        for k in left.tolist():
            word = byte_symbols(lower=False)[padded[starts[k] : ends[k]]]
            out[k] = mix(out[k : k + 1] + span_hashes(word, np.zeros(1, np.int64), n[k : k + 1]))[0]
    return out


def byte_symbols(lower: bool) -> np.ndarray:
    """A fixed random number for each byte; ``lower``: A to Z count as a to z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    if lower:
        table[0x41:0x5B] = table[0x61:0x7B]
    return table


def _is_space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(SPACE_BYTES)] = True
    return table


IS_SPACE = _is_space()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and the offset at which each begins.

    A null text has no bytes.
    """
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=wide)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text.

    Words are maximal runs of bytes that are not white space, within a text.
    """
    # subtraction wraps, so that only 0x09 to 0x0D stay below 5
    inner = (data != 0x20) & (data - np.uint8(0x09) >= 5)
    change = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        np.not_equal(inner[1:], inner[:-1], out=change[1:-1])
        change[0], change[-1] = inner[0], inner[-1]
    at = np.flatnonzero(change)
    starts, ends = at[::2], at[1::2]
    # words that touch where their texts meet
    edges = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    edges = edges[inner[edges - 1] & inner[edges]]
    if len(edges):
        starts = np.insert(starts, np.searchsorted(starts, edges), edges)
        ends = np.insert(ends, np.searchsorted(ends, edges), edges)
    return starts, ends, np.searchsorted(starts, offsets)


def parts(batch: pa.RecordBatch, text: int, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of column ``text`` (one row at least)."""
    column = batch.column(text)
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(column)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """The first word of each window of ``size`` words that lies within a text.

    ``first`` has the first word of each text, and the number of words last.
    """
    total = int(first[-1])
    inside = np.zeros(total + 1, dtype=np.int32)
    ends = np.maximum(first[1:] - size + 1, first[:-1])
    np.add.at(inside, first[:-1], 1)
    np.add.at(inside, ends, -1)
    return np.flatnonzero(np.cumsum(inside[:-1]) > 0)


def squeeze(values: np.ndarray) -> bytes:
    """An array's bytes, compressed."""
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def spread(data: bytes, dtype, n: int) -> np.ndarray:
    """The array of ``n`` numbers that ``squeeze`` packed."""
    size = n * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), dtype=dtype)


def runs(begin: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Indices that copy the runs ``which`` (each from ``begin``, of ``sizes``) one after the other."""
    n = sizes[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin[which] - (ends - n), n) + np.arange(total)
