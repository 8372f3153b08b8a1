"""Byte-level BPE encoding and decoding over a trie of distinct words.

A text is cut into words (letters, digits or other characters with the blank
before them, contractions, white space), as byte-level BPE vocabularies do.
The distinct words of a batch form a trie. Its depth-first order is the
order of the sorted words, and the states of the nodes above the current one
lie on a stack: a word enters new nodes only below the prefix it shares with
the word before, so each shared prefix is encoded once.

The state of a node is the last token of the encoding of its prefix. Two
tokens may follow each other if no merge joins across their border before
both are complete; a sequence of tokens is the BPE encoding exactly if all
its neighbours may follow each other. So the last token of a prefix is the
one suffix of it that is a token and may follow the last token of the rest,
and walking back over last tokens gives the encoding of a word.

The vocabulary file (``tokenizers`` JSON with byte-level BPE) is read on the
driver and broadcast (some MB, fixed by the vocabulary). Documents don't
move. Whole texts are encoded: long ones in pieces that are cut where a word
surely begins. Encodings of words are kept across batches up to a bound.

Defined results: a null text counts as empty, with no ids and an empty
decoded text. Ids outside the vocabulary can't be decoded and fail. Extra
columns are ignored.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.textnp import mix, parts, runs, span_hashes
from tripflow.llm.worker import lean

OTHER, LETTER, DIGIT, SPACE = range(4)
# Characters encoded at once; words whose encodings are kept.
PIECE = 1 << 20
# Bytes of word encodings, and borders of tokens, that an encoder keeps.
KEPT_BYTES, KEPT_BORDERS = 32 << 20, 400_000
# Words that an encoder keeps; each counts 150 bytes at least.
KEPT_WORDS = KEPT_BYTES // 150
NEVER = 1 << 60

# Information separators, which are no white space in vocabulary files' patterns,
# and letters and digits assigned by Unicode 16, after the tables of Python 3.13.
NO_SPACE = (0x1C, 0x1D, 0x1E, 0x1F)
UNICODE_16_LETTERS = (
    (0x1C89, 0x1C8A),
    (0xA7CB, 0xA7CD),
    (0xA7DA, 0xA7DC),
    (0x105C0, 0x105F3),
    (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4),
    (0x11380, 0x11389),
    (0x1138B, 0x1138B),
    (0x1138E, 0x1138E),
    (0x11390, 0x113B5),
    (0x113B7, 0x113B7),
    (0x113D1, 0x113D1),
    (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA),
    (0x16100, 0x1611D),
    (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF),
    (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
UNICODE_16_DIGITS = (
    (0x10D40, 0x10D49),
    (0x116D0, 0x116E3),
    (0x11BF0, 0x11BF9),
    (0x16130, 0x16139),
    (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)
# Contractions that are words of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE vocabulary without prefix space is needed")
        byte_of = _byte_of_character()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {i: t.encode() for t, i in self.special.items()}
        self.bytes |= {i: bytes(byte_of[c] for c in t) for t, i in ids.items() if t not in self.special}
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        single = {v: i for i, v in self.bytes.items() if len(v) == 1}
        size = max(self.bytes) + 1
        # how each token is made: its two parts and the rank of the merge (-1: a byte)
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.token: dict[bytes, int] = {}
        for i, text in self.bytes.items():
            if i in self.special.values():
                continue
            made = self._merge([single[text[k : k + 1]] for k in range(len(text))], text)
            if made == i:  # else no text is ever encoded with this token
                self.token[text] = i
        self.longest = max(map(len, self.token))

    def _merge(self, ids: list[int], text: bytes) -> int | None:
        """The one token that merging makes of ``ids``, or None; notes how it was made."""
        last = None
        while len(ids) > 1:
            best = min((self.merges.get(p, (NEVER, 0)) for p in zip(ids, ids[1:], strict=False)), default=(NEVER, 0))
            if best[0] == NEVER:
                return None
            out, k = [], 0
            while k < len(ids):
                if k + 1 < len(ids) and self.merges.get((ids[k], ids[k + 1])) == best:
                    last = (ids[k], ids[k + 1], best[0])
                    out.append(best[1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        if last:
            self.left[ids[0]], self.right[ids[0]], self.rank[ids[0]] = last
        return ids[0]

    def tables(self) -> dict:
        """What tasks need, as plain data."""
        size = max(self.bytes) + 1
        texts = [self.bytes.get(i, b"") for i in range(size)]
        return {
            "token": self.token,
            "longest": self.longest,
            "join": {(a << 32) | b: rank for (a, b), (rank, _) in self.merges.items()},
            "left": self.left,
            "right": self.right,
            "rank": self.rank,
            "special": self.special,
            "bytes": b"".join(texts),
            "ends": np.cumsum([len(t) for t in texts]),
        }


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a token stands for.

    Printable bytes of Latin-1 stand for themselves, the others in order for
    the characters from 256 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.cache
def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and random number of every code point."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))[0]
        if category == "L":
            kind[c] = LETTER
        elif category == "N":
            kind[c] = DIGIT
        elif category in "ZC" and chr(c).isspace() and c not in NO_SPACE:
            kind[c] = SPACE
    for ranges, value in ((UNICODE_16_LETTERS, LETTER), (UNICODE_16_DIGITS, DIGIT)):
        for first, last in ranges:
            kind[first : last + 1] = value
    return kind, mix(np.arange(1, 0x110001, dtype=np.uint64))


def word_starts(codes: np.ndarray, kind: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where words begin, as flags; ``edges`` has the first character of each text."""
    n = len(codes)
    k = kind[codes]
    first = np.zeros(n + 1, dtype=bool)
    first[edges] = True
    first[n] = True
    space = k == SPACE
    change = np.ones(n, dtype=bool)
    change[1:] = k[1:] != k[:-1]
    change |= first[:n]
    # a blank before a word belongs to it
    led = np.zeros(n, dtype=bool)
    led[1:] = (codes[:-1] == 0x20) & ~space[1:]
    led &= ~first[:n]
    starts = change & ~led
    # the last of a run of white space parts from the run, if more text follows
    last = np.zeros(n, dtype=bool)
    last[:-1] = space[:-1] & ~space[1:]
    last &= ~first[1:]
    starts |= last
    # contractions
    quote = np.flatnonzero((codes == 0x27) & starts)
    if len(quote):
        padded = np.concatenate([codes, np.zeros(2, dtype=codes.dtype)])
        ends = np.append(edges, n)[np.searchsorted(edges, quote, side="right")]
        for word in CONTRACTIONS:
            size = len(word)
            hit = quote + size <= ends
            for j in range(1, size):
                hit &= padded[np.minimum(quote + j, n)] == ord(word[j])
            at = quote[hit]
            starts[at + 1] = False
            after = at + size
            starts[after[after < n]] = True
    return starts


class Encoder:
    """Encodes batches of texts; keeps word encodings between them."""

    def __init__(self, tables: dict):
        self.t = tables
        self.kind, self.symbol = _character_tables()
        self.words: dict[str, tuple[int, ...]] = {}
        self.held = 0  # about the bytes of ``words``
        self.follows: dict[int, bool] = {}

    def may_follow(self, a: int, b: int) -> bool:
        """Whether no merge joins across the border of tokens ``a`` and ``b``."""
        key = (a << 32) | b
        known = self.follows.get(key)
        if known is not None:
            return known
        join, left, right, rank = self.t["join"], self.t["left"], self.t["right"], self.t["rank"]
        x, gone_x, ok = a, NEVER, True
        while x >= 0 and ok:  # x ends at the border from its making on, until its parent is made
            y, gone_y = b, NEVER
            while y >= 0:
                at = join.get((x << 32) | y)
                # of equal merges the left one goes first
                if at is not None and at < gone_x and at <= gone_y:
                    ok = False
                    break
                y, gone_y = left[y], rank[y]
            x, gone_x = right[x], rank[x]
        if len(self.follows) > KEPT_BORDERS:
            self.follows.clear()
        self.follows[key] = ok
        return ok

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of distinct words, by a depth-first walk over their trie."""
        token, longest, follow = self.t["token"], self.t["longest"], self.may_follow
        out = {}
        above, state = b"", [-1]  # state[d]: last token of the first d bytes of the path
        for raw, word in sorted((w.encode(), w) for w in words):
            shared, most = 0, min(len(raw), len(above))
            while shared < most and raw[shared] == above[shared]:
                shared += 1
            del state[shared + 1 :]
            for depth in range(shared + 1, len(raw) + 1):
                for start in range(max(0, depth - longest), depth):
                    t = token.get(raw[start:depth])
                    if t is not None and (start == 0 or follow(state[start], t)):
                        state.append(t)
                        break
            above = raw
            ids, depth, size = [], len(raw), self.sizes
            while depth:
                ids.append(state[depth])
                depth -= size[state[depth]]
            out[word] = tuple(ids[::-1])
        return out

    @functools.cached_property
    def sizes(self) -> list[int]:
        return np.diff(self.t["ends"], prepend=0).tolist()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        found: list[list[bytes]] = [[] for _ in texts]
        rows: list[int] = []
        pieces: list[str] = []
        held = 0
        for row, text in enumerate(texts):
            for piece in self._pieces(text or ""):
                rows.append(row)
                pieces.append(piece)
                held += len(piece)
                if held >= PIECE:
                    self._flush(rows, pieces, found)
                    rows, pieces, held = [], [], 0
        self._flush(rows, pieces, found)
        return [b"".join(x) for x in found]

    def _pieces(self, text: str) -> Iterator[str]:
        """The text's parts: special tokens, and the rest cut where words begin."""
        at = 0
        while at < len(text):
            hits = [(p, s) for s in self.t["special"] if (p := text.find(s, at)) >= 0]
            stop, mark = min(hits, default=(len(text), ""))
            while at < stop:
                cut = stop
                if stop - at > PIECE:
                    k = at + PIECE
                    # a blank between two characters that are no white space begins a word
                    while k + 1 < stop and not (
                        text[k] == " " and self.kind[ord(text[k - 1])] != SPACE and self.kind[ord(text[k + 1])] != SPACE
                    ):
                        k += 1
                    cut = k if k + 1 < stop else stop
                yield text[at:cut]
                at = cut
            if mark:
                yield mark
                at = stop + len(mark)

    def _flush(self, rows: list[int], pieces: list[str], found: list[list[bytes]]) -> None:
        if not pieces:
            return
        joined = "".join(pieces)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        edges = np.concatenate([[0], ends[:-1]])
        flags = word_starts(codes, self.kind, edges)
        special = self.t["special"]
        for lo, piece in zip(edges.tolist(), pieces, strict=True):
            if piece in special:
                flags[lo + 1 : lo + len(piece)] = False
        starts = np.flatnonzero(flags)
        stops = np.append(starts[1:], len(codes))
        hashes = span_hashes(self.symbol[codes], starts, stops)
        _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        distinct = [joined[a:b] for a, b in zip(starts[where].tolist(), stops[where].tolist(), strict=True)]
        if self.held > KEPT_BYTES or len(self.words) > KEPT_WORDS:
            self.words.clear()
            self.held = 0
        new = [w for w in distinct if w not in self.words and w not in special]
        self.held += sum(150 + 5 * len(w) for w in new)  # a string, a tuple and a number or two for each word
        self.words.update(self.encode_words(new))
        coded = [self.words[w] if w not in special else (special[w],) for w in distinct]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        flat = np.fromiter((i for c in coded for i in c), dtype="<u4", count=int(sizes.sum()))
        ids = flat[runs(np.cumsum(sizes) - sizes, sizes, which)]
        totals = np.concatenate([[0], np.cumsum(sizes[which])])
        cuts = totals[np.searchsorted(starts, np.append(edges, len(codes)))].tolist()
        for row, lo, hi in zip(rows, cuts, cuts[1:], strict=False):
            found[row].append(ids[lo:hi].tobytes())


def decode_ids(tables: dict, ids: bytes) -> str:
    """The text of ids as ``encode`` returns them; special tokens stay."""
    which = np.frombuffer(ids, dtype="<u4").astype(np.int64)
    ends = tables["ends"]
    sizes = np.diff(ends, prepend=0)
    blob = np.frombuffer(tables["bytes"], dtype=np.uint8)
    out = [
        blob[runs(ends - sizes, sizes, which[lo : lo + PIECE])].tobytes() for lo in range(0, len(which), PIECE)
    ]
    return b"".join(out).decode("utf-8", "replace")


@functools.cache
def load_tables(path: str) -> dict:
    return Vocabulary(path).tables()


def encode_texts(
    docs: DataFrame,
    vocabulary: str,
    keep: tuple[str | Column, ...] = ("doc_id",),
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """The columns ``keep`` with ``ids``, and on demand the text decoded from the ids.

    ``ids`` is binary: little-endian unsigned 32-bit integers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_tables(vocabulary))
    rows = docs.select(F.col(text_col).alias("text"), F.struct(*keep).alias("kept"))
    names = ["ids", *["decoded"] * decoded]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for whole in batches:
            for batch in parts(whole, 0, 1 << 22):
                ids = encoder.encode(batch.column(0).to_pylist())
                out = [batch.column(1), pa.array(ids, pa.binary())]
                if decoded:
                    out.append(pa.array([decode_ids(shared.value, x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["kept", *names])

    kind = rows.schema["kept"].dataType.simpleString()
    coded = rows.mapInArrow(run, f"kept {kind}, ids binary" + ", decoded string" * decoded)
    return coded.select("kept.*", *names)


def decode_texts(encoded: DataFrame, vocabulary: str, keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``decoded``, the text of the column ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_tables(vocabulary))
    rows = encoded.select("ids", F.struct(*keep).alias("kept"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(shared.value, x or b"") for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(texts, pa.string())], names=["kept", "decoded"]
            )

    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(run, f"kept {kind}, decoded string").select("kept.*", "decoded")
