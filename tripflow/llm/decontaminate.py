"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

A document is contaminated by a benchmark item of ``n`` words if some window
of ``n`` words of it has a word edit distance of at most ``floor(max_edits *
n)`` to the item (lower case, letters and digits only; past its end a
document goes on with words that match nothing).

The CGK embedding walks over a string with random bits: at step ``j`` it
writes the word under the cursor and moves on by the bit that ``(j, word)``
draws. Two strings at a small edit distance fall into step again after an
edit, so their embeddings have a small Hamming distance. Sampling ``COORDS``
of the embedding's coordinates gives a hash that two near strings share with
a fair chance; independent walks raise the chance to ``recall``. How many
it takes grows with the item's length, so the driver sets their number for
each class of lengths, by hashing random edits of that class's own items.
Windows that share a hash with an item are verified by the exact edit
distance, so no clean document is reported.

A class that ``max_repeats`` walks don't bring to ``recall`` is searched
exactly: an item is cut into one piece more than it may have edits, so every
window that matches holds a piece unchanged; all windows around such a piece
that have enough of the item's words are verified.

A window starts at every word of every document and is as long as the item.
The walk from a word doesn't depend on the window's length, so all lengths
share it; items of similar length share their samples too. Two lossless
steps keep the work small. A window can only match if all but ``floor(max_edits
* n)`` of an item's words, and of its words that are rare in the benchmark,
lie in it; running sums of benchmark words and of rare ones tell. And a walk
goes on only while the sampled words are those of some item.

Items are broadcast in blocks of at most ``block_words`` words, and each
block is one pass over the documents, so the benchmark may have any size.
Documents are read once a block and never shuffled.

Defined results: null or empty texts are clean; items of fewer than
``min_words`` words, null items and null item ids are not looked for; items
with one text each get their row; repeated documents each get their rows; a
null document id is kept as null. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.textnp import mix, parts
from tripflow.llm.worker import lean

NOISE = re.compile(r"[\W_]+")
COORDS = 2
PART, PIECE = 1 << 22, 1 << 20
# Bytes of the walks' bits that are kept, and words of windows that are compared at once.
CACHE, VERIFIED = 1 << 26, 1 << 20
GAP = -1  # a token without letters or digits


def normal_words(text: str) -> list[str]:
    """Lower-case words of letters and digits."""
    return [w for w in (NOISE.sub("", t) for t in text.lower().split()) if w]


class _Numbers(dict):
    """Word number of a token (0: no benchmark word, GAP: nothing left), learned as tokens come."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, token: str) -> int:
        word = NOISE.sub("", token)
        number = self.vocabulary.get(word, 0) if word else GAP
        if len(self) > 400_000:
            self.clear()
        self[token] = number
        return number


def _bits(seed: int, step: int, words: np.ndarray) -> np.ndarray:
    """The random bits of words at one step of one walk."""
    keys = words.astype(np.uint64) + np.uint64((seed << 40) + (step << 24))
    return (mix(mix(keys)) & np.uint64(1)).astype(np.int8)


def gram_hashes(line: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each word of a string."""
    out = np.zeros(max(0, len(line) - size + 1), dtype=np.uint64)
    for k in range(size):
        out = mix(out + line[k : k + len(out)].astype(np.uint64))
    return out


@dataclass
class Walk:
    """One CGK walk: its seed, whether it reads backwards, the sampled steps of each class of lengths."""

    seed: int
    back: bool
    steps: dict[int, tuple[int, ...]]


def plan_walks(classes: dict[int, int], repeats: int, seed: int = 11) -> list[Walk]:
    """Independent walks; ``classes`` has the least length of each class of lengths.

    The first sample comes from the walk's beginning, so that most windows
    leave it early; the others from all steps before it nears the window's
    end. Every second walk reads the window backwards, from its end.
    """
    rng = np.random.default_rng(seed)
    walks = []
    for r in range(repeats):
        steps = {}
        for c, n in classes.items():
            first = int(rng.integers(0, max(1, int(0.3 * n))))
            rest = rng.choice(np.arange(first + 1, max(first + COORDS, int(1.5 * n))), COORDS - 1, replace=False)
            steps[c] = (first, *sorted(rest.tolist()))
        walks.append(Walk(r + 1, r % 2 == 1, steps))
    return walks


def length_class(n: int) -> int:
    return int(np.log(n) / np.log(1.15))


def embed(strings: np.ndarray, walk: Walk, bits) -> np.ndarray:
    """The sampled coordinates of each row (a string of words; past it 0)."""
    n = strings.shape[1]
    steps = walk.steps[length_class(n)]
    rows = np.arange(len(strings))
    cursor = np.zeros(len(strings), dtype=np.int64)
    strings = strings[:, ::-1] if walk.back else strings
    padded = np.column_stack([strings, np.zeros(len(strings), dtype=strings.dtype)])
    out = []
    for step in range(steps[-1] + 1):
        word = padded[rows, np.minimum(cursor, n)]
        if step in steps:
            out.append(word)
        cursor += bits(walk.seed, step, word)
    return np.column_stack(out)


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Word edit distance of each row of ``a`` to the same row of ``b`` (equal lengths)."""
    n = a.shape[1]
    row = np.tile(np.arange(n + 1, dtype=np.int32), (len(a), 1))
    for i in range(1, n + 1):
        new = np.empty_like(row)
        new[:, 0] = i
        step = row[:, :-1] + (b != a[:, i - 1 : i])
        np.minimum(step, row[:, 1:] + 1, out=new[:, 1:])
        # insertions: running minimum of value minus position
        at = np.arange(n + 1, dtype=np.int32)
        row = np.minimum.accumulate(new - at, axis=1) + at
    return row[:, -1]


def random_edits(item: list[int], edits: int, rng: np.random.Generator) -> list[int]:
    """The item after ``edits`` random edits, as many of them insertions as deletions, so that its length stays."""
    out = list(item)
    while True:
        kinds = rng.integers(0, 3, edits)
        if (kinds == 1).sum() == (kinds == 2).sum():
            break
    for kind in kinds.tolist():
        at = int(rng.integers(0, max(1, len(out))))
        if kind == 0:
            out[at] = 0
        elif kind == 1:
            out.insert(at, 0)
        else:
            del out[at]
    return out


class Items:
    """A block of benchmark items, ready for tasks."""

    def __init__(self, items: list[tuple[int, list[str]]], max_edits: float):
        self.vocabulary: dict[str, int] = {}
        self.ids: dict[int, list[int]] = {}
        strings: dict[int, list[list[int]]] = {}
        for item, words in items:
            coded = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            strings.setdefault(len(words), []).append(coded)
            self.ids.setdefault(len(words), []).append(item)
        self.strings = {n: np.array(s, dtype=np.int32) for n, s in strings.items()}
        self.edits = {n: int(max_edits * n + 1e-9) for n in strings}
        # words of at most a hundredth of the items are rare
        uses = np.zeros(len(self.vocabulary) + 1, dtype=np.int64)
        for s in self.strings.values():
            for item in s:
                uses[np.unique(item)] += 1
        self.rare = uses <= max(1, len(items) // 100)
        self.rare[0] = False
        self.walks: list[Walk] = []
        self.repeats: dict[int, int] = {}  # walks of each class of lengths; 0: searched exactly
        self._cache: dict[tuple[int, int], np.ndarray] = {}

    def groups(self) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """Items as (length, number), by class of length and by their share of rare words."""
        out: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, s in sorted(self.strings.items()):
            for k, share in enumerate((self.rare[s].mean(axis=1) * 5).astype(int).tolist()):
                out.setdefault((length_class(n), share), []).append((n, k))
        return out

    def bits(self, seed: int, step: int, words: np.ndarray) -> np.ndarray:
        got = self._cache.get((seed, step))
        if got is None:
            size = len(self.vocabulary) + 1
            if len(self._cache) * size > CACHE:
                return _bits(seed, step, words)
            got = self._cache[seed, step] = _bits(seed, step, np.arange(size))
        return got[words]

    def plan(self, recall: float, most: int, trials: int = 1000) -> None:
        """For each class of lengths as many walks as random edits of its items need to be found with ``recall``."""
        rng = np.random.default_rng(5)
        classes: dict[int, list[int]] = {}
        for n in sorted(self.strings):
            classes.setdefault(length_class(n), []).append(n)
        self.walks = plan_walks({c: lengths[0] for c, lengths in classes.items()}, most)
        for c, lengths in classes.items():
            total = sum(len(self.strings[n]) for n in lengths)
            whole, near = [], []
            for n in lengths:
                whole.append(self.strings[n][rng.integers(0, len(self.strings[n]), -(-trials * len(self.strings[n]) // total))])
                near.append(np.array([random_edits(s.tolist(), self.edits[n], rng) for s in whole[-1]], dtype=np.int32))
            counted, self.repeats[c] = sum(map(len, whole)), 0
            for k, walk in enumerate(self.walks):
                for g, (x, y) in enumerate(zip(whole, near, strict=True)):
                    if len(x):
                        missed = (embed(y, walk, self.bits) != embed(x, walk, self.bits)).any(axis=1)
                        whole[g], near[g] = x[missed], y[missed]
                if sum(map(len, whole)) <= (1 - recall) * counted:
                    self.repeats[c] = k + 1
                    break
            if not self.repeats[c] and any(self.edits[n] >= n for n in lengths):
                raise ValueError("an item may not have as many edits as words")
        self.walks = self.walks[: max(self.repeats.values())]
        self._cache = {}


class Finder:
    """Searches batches of documents for a block of items."""

    def __init__(self, items: Items):
        self.items = items
        self.numbers = _Numbers(items.vocabulary)
        self.reach = max(items.strings)
        # for each group of items and each walk, the samples as a trie: the sorted keys of each level
        # (number of the node above, word), and the items below each last node
        samples = {
            n: [embed(s, w, items.bits) for w in items.walks[: items.repeats[length_class(n)]]]
            for n, s in items.strings.items()
        }
        self.groups = []
        for (kind, _), members in items.groups().items():
            tries = [
                self._trie(np.array([samples[n][w][k] for n, k in members])) for w in range(items.repeats[kind])
            ]
            seeds = {} if tries else self._seeds(members)
            least = min(n - items.edits[n] for n, _ in members)
            rare = min(int(items.rare[items.strings[n][k]].sum()) - items.edits[n] for n, k in members)
            self.groups.append((kind, members, max(n for n, _ in members), least, rare, tries, seeds))

    def _seeds(self, members: list[tuple[int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By size: the hashes of the items' pieces in order, the member of each, and where in the item it begins."""
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for member, (n, k) in enumerate(members):
            pieces = self.items.edits[n] + 1
            size, offset = n // pieces, np.arange(pieces) * n // pieces
            keys = gram_hashes(self.items.strings[n][k], size)[offset]
            found.setdefault(size, []).append((keys, np.full(pieces, member), offset))
        out = {}
        for size, parts_ in found.items():
            keys, member, offset = (np.concatenate(x) for x in zip(*parts_, strict=True))
            by = np.argsort(keys, kind="stable")
            out[size] = (keys[by], member[by], offset[by])
        return out

    def _trie(self, samples: np.ndarray):
        size = len(self.items.vocabulary) + 1
        node, levels = np.zeros(len(samples), dtype=np.int64), []
        for k in range(samples.shape[1]):
            keys, node = np.unique(node * size + samples[:, k], return_inverse=True)
            levels.append(keys)
        order = np.argsort(node, kind="stable")
        return levels, order, np.searchsorted(node[order], np.arange(len(levels[-1]) + 1))

    def words(self, text: str) -> np.ndarray:
        """Word numbers of a text; long texts go piece by piece."""
        out, at = [], 0
        while at < len(text):
            end = at + PIECE
            while end < len(text) and not text[end].isspace():
                end += 1
            got = np.fromiter(map(self.numbers.__getitem__, text[at:end].lower().split()), dtype=np.int32)
            out.append(got[got != GAP])
            at = end
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """Rows (text, item, distance, first word, words) of the best window of each match."""
        words = [self.words(t) if t else np.empty(0, np.int32) for t in texts]
        gap = np.zeros(self.reach, dtype=np.int32)
        # a gap before each text and after the last, so that windows may reach beyond a text either way
        stream = np.concatenate([gap, *(x for w in words for x in (w, gap))])
        sizes = np.array([len(w) + self.reach for w in words], dtype=np.int64)
        begin = self.reach + np.cumsum(sizes) - sizes
        own = np.zeros(len(stream), dtype=bool)  # windows begin in a text, not in a gap
        for lo, w in zip(begin.tolist(), words, strict=True):
            own[lo : lo + len(w)] = True
        ways = []
        for line in (stream, stream[::-1]):
            known, rare = (
                np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (line > 0, self.items.rare[line])
            )
            ways.append((np.ascontiguousarray(line), known, rare))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        grams = {size: gram_hashes(stream, size) for size in {size for *_, seeds in self.groups for size in seeds}}
        for kind, members, width, least, least_rare, tries, seeds in self.groups:
            lengths = np.array([n for n, _ in members])
            pairs = [np.empty(0, dtype=np.int64)]
            for at, member in self._around(stream, own, ways[0], grams, members, seeds):
                pairs.append(at * len(members) + member)
            for back, (line, known, rare) in enumerate(ways if tries else []):
                near = known[width:] - known[:-width] >= least
                near &= rare[width:] - rare[:-width] >= least_rare
                starts = np.flatnonzero(near)
                if not len(starts):
                    continue
                for walk, trie in zip(self.items.walks, tries, strict=False):
                    if walk.back == bool(back):
                        at, which = self._meet(line, starts, walk, walk.steps[kind], trie)
                        if back:
                            at = len(stream) - at - lengths[which]
                            at, which = at[at >= 0], which[at >= 0]
                        at, which = at[own[at]], which[own[at]]
                        pairs.append(at * len(members) + which)
            both = np.unique(np.concatenate(pairs))
            at, member = both // len(members), both % len(members)
            length = lengths[member]
            for n in np.unique(length).tolist():
                a_n = at[length == n]
                w_n = np.array([k for _, k in members])[member[length == n]]
                edits, strings = self.items.edits[n], self.items.strings[n]
                step = max(1, min(8192, VERIFIED // n))
                for lo in range(0, len(a_n), step):
                    a, w = a_n[lo : lo + step], w_n[lo : lo + step]
                    far = edit_distances(stream[a[:, None] + np.arange(n)], strings[w])
                    for k in np.flatnonzero(far <= edits).tolist():
                        text = int(np.searchsorted(begin, a[k], side="right")) - 1
                        item = self.items.ids[n][int(w[k])]
                        found = (int(far[k]), int(a[k] - begin[text]), n)
                        if found < best.get((text, item), (1 << 30,)):
                            best[text, item] = found
        return [(text, item, *found) for (text, item), found in sorted(best.items())]

    def _around(self, stream, own, way, grams, members, seeds):
        """For each item (a member and the windows' starts) all windows that hold a piece of it and may match."""
        _, known, rare = way
        hits = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))]
        for size, (keys, member, offset) in seeds.items():
            first = np.searchsorted(keys, grams[size])
            at = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == grams[size])
            many = np.searchsorted(keys, grams[size][at], side="right") - first[at]
            of = np.repeat(first[at], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            hits.append((member[of], np.repeat(at, many) - offset[of]))
        which, begin = (np.concatenate(x) for x in zip(*hits, strict=True))
        for m in np.unique(which).tolist():
            n, k = members[m]
            item, edits = self.items.strings[n][k], self.items.edits[n]
            # a piece that is moved by d words has d edits before it and d after it
            far = edits // 2
            of_item = np.zeros(len(self.items.vocabulary) + 1, dtype=bool)
            of_item[item] = True
            least_rare = int(self.items.rare[item].sum()) - edits
            near = np.unique(begin[which == m])
            for lo in range(0, len(near), 1 << 14):
                some = near[lo : lo + (1 << 14)]
                low = some - far
                low[1:] = np.maximum(low[1:], some[:-1] + far + 1)
                many = some + far + 1 - low
                a = np.repeat(low - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
                a = a[(a >= 0) & (a < len(own))]
                a = a[own[a]]
                a = a[(known[a + n] - known[a] >= n - edits) & (rare[a + n] - rare[a] >= least_rare)]
                step = max(1, VERIFIED // n)
                for b in range(0, len(a), step):
                    x = a[b : b + step]
                    x = x[of_item[stream[x[:, None] + np.arange(n)]].sum(axis=1) >= n - edits]
                    if len(x):
                        yield x, m

    def _meet(self, stream, starts, walk, steps, trie):
        """Windows and items with equal samples in one walk."""
        levels, order, ends = trie
        size = len(self.items.vocabulary) + 1
        cursor, node = np.zeros(len(starts), dtype=np.int32), np.zeros(len(starts), dtype=np.int64)
        level = 0
        for step in range(steps[-1] + 1):
            word = stream[np.minimum(starts + cursor, len(stream) - 1)]
            if step == steps[level]:
                keys, value = levels[level], node * size + word
                at = np.searchsorted(keys, value)
                at[at == len(keys)] = 0
                hit = keys[at] == value
                starts, cursor, word, node = starts[hit], cursor[hit], word[hit], at[hit]
                level += 1
                if level == len(steps):
                    break
            cursor = cursor + self.items.bits(walk.seed, step, word)
        many = ends[node + 1] - ends[node]
        offset = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(starts, many), order[np.repeat(ends[node], many) + offset]


def item_blocks(
    benchmark: DataFrame, max_edits: float, recall: float, min_words: int, max_repeats: int, block_words: int
) -> Iterator[Items]:
    """The items in blocks of bounded size, each with its walks planned."""
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long"), "text"
    )
    sizes = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = sizes // (4 * block_words) + 1
    for b in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        listed = [(r["item_id"], w) for r in chosen if len(w := normal_words(r["text"])) >= min_words]
        if listed:
            block = Items(sorted(listed), max_edits)
            block.plan(recall, max_repeats)
            yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    max_edits: float = 0.2,
    recall: float = 0.97,
    min_words: int = 5,
    max_repeats: int = 48,
    block_words: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id, item_id, distance, first_word, n_words), one for each document and item found."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id long, distance int, first_word long, n_words int"
    rows = docs.select(id_col, F.col(text_col).alias("text"))
    found = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, max_edits, recall, min_words, max_repeats, block_words):
        here = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), id_col), schema)
        found = found.unionByName(here)
    return found


def _search(shared, id_col: str):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for whole in batches:
            for batch in parts(whole, 1, PART):
                got = finder.search(batch.column(1).to_pylist())
                columns = list(zip(*got, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
                row, *values = (pa.array(c, k) for c, k in zip(columns, kinds, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), *values],
                    names=[id_col, "item_id", "distance", "first_word", "n_words"],
                )

    return run


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    max_edits: float = 0.2,
    recall: float = 0.97,
    min_words: int = 5,
    max_repeats: int = 48,
    block_words: int = 1_000_000,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, all columns unchanged; no row moves."""
    at = docs.columns.index(text_col)

    def pure(shared):
        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value)
            for whole in batches:
                for batch in parts(whole, at, PART):
                    hit = {row for row, *_ in finder.search(batch.column(at).to_pylist())}
                    yield batch.filter(pa.array([k not in hit for k in range(batch.num_rows)], pa.bool_()))

        return run

    context = docs.sparkSession.sparkContext
    for block in item_blocks(benchmark, max_edits, recall, min_words, max_repeats, block_words):
        docs = docs.mapInArrow(pure(context.broadcast(block)), docs.schema)
    return docs
