"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``dim`` signs, drawn from a hash of its
code point, so all tasks agree without a table. An n-gram binds its letters:
the vector of its k-th letter is rotated by its distance from the end, and
the rotated vectors are multiplied. A text bundles (adds up) the vectors of
all its n-grams; a language's prototype bundles the unit vectors of its
training texts. A text belongs to the prototype with the largest cosine.

Letters are lower-cased; every run of other characters counts as one blank,
texts begin and end with a blank. Bundling is linear, so a text's vector is
the count of each distinct n-gram times that n-gram's vector; the counts of
a batch of texts form a matrix, and one matrix product gives all bundles.

Training sums are added up in Spark by (language, component); what reaches
the driver is one vector for each language. Whole texts are read: long ones
in pieces that overlap by ``n - 1`` letters, so memory follows the batch.

A text that resembles no language still has cosines of about ``1 /
sqrt(dim)``, by chance. What a cosine can tell depends on how many different
n-grams the text has, so ``accepted`` sets its threshold by classes of their
effective number (a repeated n-gram adds little to it).

Defined results: a null text, or one without a letter, is ``und`` with score
0. Without training texts every text is ``und``. A tie goes to the language
that sorts first. The score is the cosine with the chosen prototype, cut to
0 to 1. Extra columns are ignored; repeated rows each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.worker import lean

UNKNOWN = "und"
BLANK = 0x20
# Characters of a piece of text, and cells of a batch's count matrix.
PIECE = 1 << 20
CELLS = 4_000_000
# Standard deviations up to which a cosine may be chance, effective n-grams of the shortest text that is judged by its
# cosine, and classes of sizes.
CHANCE, JUDGED, CLASSES = 4, 32, 40


def letter_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """One row of signs (+1, -1) for each code point."""
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        x = x + np.arange(1, dim // 64 + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.view(np.uint8).reshape(len(codes), -1), axis=1)
    return (bits.astype(np.float32) * 2 - 1)[:, :dim]


class Bundler:
    """Bundles of texts; keeps one table of which code points are letters."""

    def __init__(self, dim: int, n: int):
        if dim % 64 or n < 1:
            raise ValueError("dim must be a multiple of 64 and n at least 1")
        self.dim, self.n = dim, n
        self.known = np.zeros(0x110000, dtype=np.int8)  # 1 letter, -1 other, 0 not looked up

    def letters(self, text: str) -> np.ndarray:
        """Code points of the lower-cased letters, runs of others as one blank."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        kind = self.known[codes]
        if not kind.all():
            for c in np.unique(codes[kind == 0]).tolist():
                self.known[c] = 1 if chr(c).isalpha() else -1
            kind = self.known[codes]
        letter = kind > 0
        if not letter.any():
            return np.empty(0, dtype=np.uint32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of each run of others that follows a letter
        out = np.where(letter, codes, BLANK)[keep].astype(np.uint32)
        ends = [] if out[-1] == BLANK else [BLANK]
        return np.concatenate([[BLANK], out, ends]).astype(np.uint32)

    def grams(self, codes: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Bundles of ``rows`` texts, given as letters and the row of each."""
        n = self.n
        present = np.zeros(int(codes.max()) + 1, dtype=bool)
        present[codes] = True
        alphabet = np.flatnonzero(present)
        small = np.zeros(len(present), dtype=np.int64)
        small[alphabet] = np.arange(len(alphabet))
        short = small[codes]
        size = len(codes) - n + 1
        if size <= 0:
            return np.zeros((rows, self.dim), dtype=np.float32), np.zeros(rows)
        key = np.zeros(size, dtype=np.int64)
        for k in range(n):
            key = key * len(alphabet) + short[k : k + size]
        whole = owner[:size] == owner[n - 1 :]
        key, of = key[whole], owner[:size][whole]
        if len(alphabet) ** n <= 1 << 22:
            seen = np.bincount(key, minlength=1) > 0
            distinct = np.flatnonzero(seen)
            index = np.cumsum(seen) - 1
            at = index[key]
        else:
            distinct, at = np.unique(key, return_inverse=True)
        vectors = letter_vectors(alphabet, self.dim)
        out = np.zeros((rows, self.dim), dtype=np.float32)
        width = max(1, CELLS // rows)
        for lo in range(0, len(distinct), width):  # a block of n-grams at a time
            block, rest = distinct[lo : lo + width], None
            bound = np.ones((len(block), self.dim), dtype=np.float32)
            rest = block
            for k in range(n):  # the last letter is not rotated
                bound *= np.roll(vectors, k, axis=1)[rest % len(alphabet)]
                rest = rest // len(alphabet)
            inside = (at >= lo) & (at < lo + width) if len(distinct) > width else slice(None)
            counts = np.bincount(of[inside] * len(block) + (at[inside] - lo), minlength=rows * len(block))
            out += counts.reshape(rows, len(block)).astype(np.float32) @ bound
        return out, np.bincount(of, minlength=rows)

    def bundles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The bundle of each text, and its number of n-grams."""
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        total = np.zeros(len(texts))
        codes: list[np.ndarray] = []
        rows: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if codes:
                ids = np.unique(rows)
                owner = np.repeat(np.searchsorted(ids, rows), [len(c) for c in codes])
                # pieces of one text share a row but not an n-gram: a blank owner parts them
                part = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
                got, n = self._pieces(np.concatenate(codes), owner, part, len(ids))
                out[ids] += got
                total[ids] += n
            codes.clear()
            rows.clear()
            held = 0

        for row, text in enumerate(texts):
            letters = self.letters(text) if text else np.empty(0, dtype=np.uint32)
            for lo in range(0, max(0, len(letters) - self.n + 1), PIECE):
                piece = letters[lo : lo + PIECE + self.n - 1]
                codes.append(piece)
                rows.append(row)
                held += len(piece)
                if held >= PIECE:
                    flush()
        flush()
        return out, total

    def _pieces(self, codes, owner, part, rows):
        # n-grams must lie within one piece; the rows of pieces are added up afterwards
        got, n = self.grams(codes, part, int(part[-1]) + 1)
        first = np.concatenate([[True], part[1:] != part[:-1]])
        of = owner[first]
        out = np.zeros((rows, self.dim), dtype=np.float32)
        np.add.at(out, of, got)
        return out, np.bincount(of, weights=n, minlength=rows)


def train_profiles(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dim: int = 512, n: int = 3
) -> dict[str, np.ndarray]:
    """The prototype (unit vector) of each language of the training rows.

    Rows without language or letters are not used. One vector for each
    language reaches the driver.
    """

    @lean
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, total = Bundler(dim, n), {}
        for batch in batches:
            got, grams = bundler.bundles(batch.column("text").to_pylist())
            norm = np.linalg.norm(got, axis=1)
            langs = batch.column("lang").to_pylist()
            for row in np.flatnonzero((grams > 0) & (norm > 0)):
                lang = langs[row]
                total[lang] = total.get(lang, 0) + got[row].astype(np.float64) / norm[row]
        for lang, vector in total.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * dim), "at": pa.array(np.arange(dim, dtype=np.int32)), "value": pa.array(vector)}
            )

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    added = (
        rows.mapInArrow(sums, "lang string, at int, value double")
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("cells"))
        .select("lang", F.col("cells.value").alias("vector"))
    )
    out = {}
    for r in added.collect():  # one row for each language
        vector = np.array(r["vector"])
        norm = np.linalg.norm(vector)
        if norm > 0:
            out[r["lang"]] = vector / norm
    return out


def size_class(grams: np.ndarray, norm: np.ndarray, dim: int) -> np.ndarray:
    """Class of a text's effective number of n-grams, by powers of two: as many different ones have a bundle of its norm."""
    effective = dim * (grams / norm) ** 2
    return np.clip(np.log2(np.maximum(effective, 1)), 0, CLASSES - 1).astype(np.int32)


def thresholds(medians: dict[int, float], dim: int) -> list[float | None]:
    """The least score of each class of sizes, from the median of its training scores; None: all texts stay.

    It lies between chance and half the median, if that is well above chance;
    larger classes have at least the threshold of smaller ones.
    """
    chance, least, out = CHANCE / dim**0.5, None, []
    for c in range(CLASSES):
        half = medians.get(c, 0.0) / 2
        if 1 << c >= JUDGED and half >= 1.5 * chance:
            least = max(least or 0.0, (chance * half) ** 0.5)
        out.append(least)
    return out


def identified_rows(
    docs: DataFrame,
    profiles: dict[str, np.ndarray],
    text_col: str = "text",
    keep: list[str | Column] = ("doc_id",),
    n: int = 3,
) -> DataFrame:
    """Rows (kept, lang_pred, score, size); ``kept`` is a struct of the columns ``keep``, ``size`` a class of sizes."""
    langs = sorted(profiles)
    dim = len(profiles[langs[0]]) if langs else 64
    matrix = np.array([profiles[x] for x in langs], dtype=np.float32).T
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).alias("text"))

    @lean
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(dim, n)
        for batch in batches:
            rows = batch.num_rows
            pred, score = np.full(rows, UNKNOWN, dtype=object), np.zeros(rows)
            size = np.zeros(rows, dtype=np.int32)
            if langs and rows:
                got, grams = bundler.bundles(batch.column(1).to_pylist())
                norm = np.linalg.norm(got, axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    cosine = (got @ matrix) / norm[:, None]
                best = np.argmax(cosine, axis=1)
                sure = (grams > 0) & (norm > 0)
                pred[sure] = np.array(langs, dtype=object)[best[sure]]
                score[sure] = np.clip(cosine[np.arange(rows), best][sure], 0, 1)
                size[sure] = size_class(grams[sure], norm[sure], dim)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(size)],
                names=["kept", "lang_pred", "score", "size"],
            )

    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(predict, f"kept {kind}, lang_pred string, score double, size int")


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], **settings) -> DataFrame:
    """The kept columns with ``lang_pred`` and ``score``; settings as for ``identified_rows``."""
    return identified_rows(docs, profiles, **settings).select("kept.*", "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float = 0.0, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a recognised language, all columns unchanged.

    Profiles and thresholds are learned from the rows' own ``lang``. A row
    goes if its text has no letter, or has enough n-grams to be judged and
    resembles no language (score up to ``min_score`` or under the threshold
    of its class of sizes). Texts too short to be judged stay. Without
    profiles (no row has a language) only texts without a letter go.
    """
    profiles = train_profiles(docs, lang_col, text_col)
    if not profiles:
        return docs.filter(F.col(text_col).rlike(r"\p{L}"))
    trained = identified_rows(docs.filter(F.col(lang_col).isNotNull()), profiles, text_col, keep=[F.lit(1).alias("one")])
    medians = trained.filter(F.col("lang_pred") != UNKNOWN).groupBy("size").agg(F.percentile_approx("score", 0.5).alias("m"))
    least = thresholds(
        {r["size"]: r["m"] for r in medians.collect()},  # CLASSES rows at most
        len(next(iter(profiles.values()))),
    )
    found = identified_rows(docs, profiles, text_col, keep=list(docs.columns))
    bound = F.array(*(F.lit(x).cast("double") for x in least))[F.col("size")]
    stays = bound.isNull() | ((F.col("score") >= bound) & (F.col("score") > min_score))
    return found.filter((F.col("lang_pred") != UNKNOWN) & stays).select("kept.*")
