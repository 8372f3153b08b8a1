"""Toxicity scores by weak supervision.

1. **Lexicons.** Words and word beginnings that go with toxic labels are
   counted over a bounded sample of labelled rows (``max_labelled``). Those
   that go with them beyond chance, the ``max_features`` strongest at most,
   are the classifier's features, and the precise ones form the lexicons.
2. **Voters.** Each lexicon voter, hand-written list and text pattern votes
   toxic, votes clean or abstains. Every unlabelled and labelled training
   text is read; Spark counts the texts of each vote pattern. There are
   ``2 ** VOTERS`` patterns at most, so their counts have a fixed bound.
3. **Label model.** A generative model of (label, votes), fitted by EM on the
   pattern counts: a class prior, how often each voter fires in each class
   (its accuracy), and factors for pairs of voters that still correlate
   within a class. A row's label is one more vote, whose accuracy in either
   class is learned too (from ``TRUST`` on). It gives every pattern, with a
   label or without, a posterior.
4. **Classifier.** Logistic regression on the features, fitted to the
   posterior labels of a bounded sample of training rows (``max_fit``).
   It scores every text; a score sees the text only.

What reaches the driver: the features, the pattern counts and the sample's
feature numbers, each bounded by a parameter.

Defined results: a null text counts as empty; empty texts get the score of a
text without features. Without labels the hand-written list and the patterns
are the only voters; without training rows every score is the prior's.
Labels that are null, or rows of ``labels`` without a text, are not used; of
several labels of a text the largest counts. Repeated rows each get a score.
Extra columns are ignored. Long texts are read in pieces.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import settle
from tripflow.llm.worker import lean

WORD = re.compile(r"[^\W\d_]+")
SHOUT = re.compile(r"\b[A-Z]{4,}\b")
LOOSE = re.compile(r"[.!?]\s+([^\W\d_]+)")
PIECE = 1 << 20

# Common terms of abuse in the four languages of the corpus.
INSULTS = frozenset(
    "idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown "
    "dumb dumbass jerk bastard bitch asshole imbecile cretin filth vermin "
    "idiota estúpido estúpida imbécil basura escoria asqueroso payaso "
    "crétin imbécile ordure salaud connard dégoûtant minable "
    "dummkopf abschaum arschloch schwachkopf widerlich erbärmlich drecksau".split()
)
PREFIXES = (4, 5, 6)
VOTERS = 14
CLEAN_VOTERS = (12, 13)
# Accuracy of a label to begin with, and of how many labels of a class that is thought to be known.
TRUST, TRUSTED = 0.99, 20.0


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return ["=" + word, *(f"{k}{word[:k]}" for k in PREFIXES if len(word) > k)]


def distinct_words(text: str) -> set[str]:
    """The lower-cased words of a whole text; long texts go piece by piece."""
    if len(text) <= PIECE:
        return set(WORD.findall(text.lower()))
    found: set[str] = set()
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end].isalpha():
            end += 1
        found.update(WORD.findall(text[at:end].lower()))
        at = end
    return found


@dataclass
class Lexicon:
    """Feature numbers, and which features each lexicon voter knows."""

    index: dict[str, int]
    voter: dict[int, int]
    cache: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def found(self, word: str) -> tuple[int, ...]:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) > 500_000:
                self.cache.clear()
            got = tuple(k for f in features_of(word) if (k := self.index.get(f)) is not None)
            self.cache[word] = got
        return got

    def read(self, text: str) -> tuple[set[int], int, set[str]]:
        """Feature numbers, number of distinct lexicon words, distinct words of a text."""
        words, hits, strong = distinct_words(text), set(), 0
        for w in words:
            if got := self.found(w):
                hits.update(got)
                strong += any(k in self.voter for k in got)
        return hits, strong, words

    def votes(self, text: str) -> tuple[int, set[int]]:
        """The voters that fire, as bits, and the feature numbers."""
        hits, strong, words = self.read(text)
        fired = {self.voter[k] for k in hits if k in self.voter}
        listed = not words.isdisjoint(INSULTS)
        if listed:
            fired.add(8)
        if strong >= 2:
            fired.add(9)
        if any(w.islower() for w in LOOSE.findall(text)):
            fired.add(10)
        if len(SHOUT.findall(text)) >= 3:
            fired.add(11)
        if not strong and not listed:
            fired.add(12)
            if len(words) >= 40:
                fired.add(13)
        return sum(1 << v for v in fired), hits


def mine_lexicon(labelled: DataFrame, max_features: int) -> Lexicon:
    """Lexicons from rows (text, toxic); counts are added up in Spark."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, total = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {f for w in distinct_words(text or "") for f in features_of(w)}
                total.update(found)
                if label:
                    toxic.update(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(list(total), pa.string()),
                    "toxic": pa.array([toxic[f] for f in total], pa.int64()),
                    "n": pa.array(list(total.values()), pa.int64()),
                }
            )

    rows = labelled.select("text", F.col("toxic").cast("int"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, n1 = sizes["n"], sizes["toxic"] or 0
    if not n1 or n1 == n:
        return Lexicon({}, {})
    counted = (
        rows.mapInArrow(count, "feature string, toxic long, n long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        .filter("n >= 3")
    )
    counted = settle(counted, "toxicity-features")
    # log-likelihood ratio of "toxic texts have it more often" against "it tells nothing",
    # which must exceed what the best of so many features reaches by chance
    a, m, base = F.col("toxic"), F.col("n"), n1 / n
    part = lambda k, share: F.when(k > 0, k * F.log(k / m / share)).otherwise(0.0)
    strength = 2 * (part(a, base) + part(m - a, 1 - base))
    least = 2 * float(np.log(max(1, counted.count()))) + 4
    best = (
        counted.withColumn("strength", strength)
        .filter((F.col("strength") >= least) & (a > base * m))
        .orderBy(F.desc("strength"), "feature")
        .limit(max_features)
        .collect()
    )
    index, voter = {}, {}
    for k, r in enumerate(best):
        index[r["feature"]] = k
        if r["toxic"] >= 0.5 * r["n"]:
            kind = 0 if r["feature"][0] == "=" else 2 * (1 + PREFIXES.index(int(r["feature"][0])))
            voter[k] = kind + k % 2
    return Lexicon(index, voter)


@dataclass
class LabelModel:
    """Posteriors of all vote patterns, and what they rest on."""

    posterior: np.ndarray
    prior: float
    accuracy: list[float]
    correlations: list[tuple[int, int, float]]
    # the label as one more voter: P(label 1 | class 0), P(label 1 | class 1)
    marks: tuple[float, float]

    def target(self, pattern: int, label: int | None) -> float:
        """Posterior of class 1 given the votes, and the label where there is one."""
        p = float(self.posterior[pattern])
        return p if label is None else float(with_label(np.array([p]), label, self.marks)[0])


def with_label(posterior: np.ndarray, label: int, marks: tuple[float, float]) -> np.ndarray:
    """Posteriors after a label's vote, by Bayes."""
    zero, one = marks if label else (1 - marks[0], 1 - marks[1])
    return posterior * one / (posterior * one + (1 - posterior) * zero)


def fit_label_model(counts: dict[tuple[int, int], int], rounds: int = 20, most_pairs: int = 16) -> LabelModel:
    """EM over counts of (pattern, label), label 0, 1 or -1 for none."""
    cells = 1 << VOTERS
    bits = ((np.arange(cells)[:, None] >> np.arange(VOTERS)) & 1).astype(np.float64)
    weight = np.zeros((3, cells))
    for (pattern, label), n in counts.items():
        weight[label + 1, pattern] += n
    total = weight.sum()
    # start: the share of toxic votes among all votes
    toxic = bits.copy()
    toxic[:, list(CLEAN_VOTERS)] = 0
    clean = bits[:, list(CLEAN_VOTERS)].sum(axis=1)
    posterior = (toxic.sum(axis=1) + 0.1) / (toxic.sum(axis=1) + 2 * clean + 1)
    prior = 0.1

    def responsibilities(p: np.ndarray) -> np.ndarray:
        """Posterior weight of class 1 of each (label, cell)."""
        return np.stack([p, with_label(p, 0, marks), with_label(p, 1, marks)])

    def mark_rates(r: np.ndarray) -> tuple[float, float]:
        """How often either class has label 1, as if ``TRUSTED`` labels of each class had been right at the rate TRUST."""
        rates = []
        for share, start in ((1 - r, 1 - TRUST), (r, TRUST)):
            held = (weight * share).sum(axis=1)
            rates.append(float((held[2] + TRUSTED * start) / (held[1] + held[2] + TRUSTED)))
        return rates[0], rates[1]

    def fit(phi: np.ndarray, w: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-linear distribution over cells with the moments of ``w``."""
        size = w.sum() + 2.0
        goal = (w @ phi + (phi.mean(axis=0) * 2.0)) / size
        for _ in range(8):
            score = phi @ theta
            p = np.exp(score - score.max())
            p /= p.sum()
            mean = p @ phi
            step = goal - mean - 1e-4 * theta
            if np.abs(step).max() < 1e-6:
                break
            spread = (phi * p[:, None]).T @ phi - np.outer(mean, mean) + 1e-3 * np.eye(len(theta))
            move = np.linalg.solve(spread, step)
            theta = theta + move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        score = phi @ theta
        return theta, score - score.max() - np.log(np.exp(score - score.max()).sum())

    phi, pairs, marks = bits, [], (1 - TRUST, TRUST)
    thetas = [np.zeros(VOTERS), np.zeros(VOTERS)]
    if total:
        for turn in range(2):  # first without pairs, then with those that still correlate
            for _ in range(rounds):
                r = responsibilities(posterior)
                marks = mark_rates(r)
                one, zero = (weight * r).sum(axis=0), (weight * (1 - r)).sum(axis=0)
                prior = float((one.sum() + 1) / (total + 20))
                logs = []
                for y, w in ((0, zero), (1, one)):
                    thetas[y], log = fit(phi, w, thetas[y])
                    logs.append(log)
                odds = np.log(prior / (1 - prior)) + logs[1] - logs[0]
                posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            if turn == 0:
                found = []
                for w in (zero, one):
                    mean = w @ bits / max(w.sum(), 1)
                    cov = (bits * w[:, None]).T @ bits / max(w.sum(), 1) - np.outer(mean, mean)
                    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                    found.append(cov / np.outer(sd, sd))
                strength = np.maximum(np.abs(found[0]), np.abs(found[1]))
                rank = sorted(((strength[i, j], i, j) for i in range(VOTERS) for j in range(i)), reverse=True)
                pairs = [(j, i, float(s)) for s, i, j in rank[:most_pairs] if s > 0.1]
                phi = np.column_stack([bits, *[bits[:, a] * bits[:, b] for a, b, _ in pairs]])
                thetas = [np.concatenate([t, np.zeros(len(pairs))]) for t in thetas]
    r = responsibilities(posterior)
    one, all_ = (weight * r).sum(axis=0) @ bits, weight.sum(axis=0) @ bits
    right = [(all_[v] - one[v]) if v in CLEAN_VOTERS else one[v] for v in range(VOTERS)]
    accuracy = [float((right[v] + 1) / (all_[v] + 2)) for v in range(VOTERS)]
    return LabelModel(posterior, prior, accuracy, pairs, marks)


def fit_linear(
    rows: list[list[int]], targets: np.ndarray, features: int, prior: float, rounds: int = 200
) -> tuple[np.ndarray, float]:
    """Logistic regression on present features, to soft targets."""
    bias = float(np.log(prior / (1 - prior)))
    weights = np.zeros(features)
    if not rows or not features:
        return weights, bias
    sizes = np.array([len(r) for r in rows])
    at = np.repeat(np.arange(len(rows)), sizes)
    col = np.array([k for r in rows for k in r], dtype=np.int64)
    first, second = np.zeros(features + 1), np.zeros(features + 1)
    for turn in range(1, rounds + 1):
        score = bias + np.bincount(at, weights=weights[col], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - targets) / len(rows)
        grad = np.append(np.bincount(col, weights=error[at], minlength=features) + 1e-4 * weights, error.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        move = 0.1 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-6)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    return weights, bias


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float
    labels: LabelModel


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = 20_000,
    max_fit: int = 20_000,
    max_features: int = 4096,
) -> ToxicityModel:
    """Fit on all rows of ``docs`` (training rows only) and their ``labels``.

    The lexicons come from ``max_labelled`` labelled rows at most and the
    classifier from ``max_fit`` rows at most, those with the smallest hashes
    of their ids; the vote counts cover all rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    )
    order = F.xxhash64(F.col("id"), F.lit(17))
    # every label meets its row's id only; texts stay where they are
    chosen = marks.join(rows.select("id").distinct(), "id").orderBy(order, "id").limit(max_labelled).collect()
    sample = spark.createDataFrame([tuple(r) for r in chosen], marks.schema)
    lexicon = mine_lexicon(rows.join(F.broadcast(sample), "id"), max_features)
    bare = Lexicon(lexicon.index, lexicon.voter)
    shared = spark.sparkContext.broadcast(bare)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[known.votes(text or "")[0], -1 if label is None else label] += 1
        yield pa.RecordBatch.from_pydict(
            {
                "pattern": pa.array([p for p, _ in seen], pa.int32()),
                "label": pa.array([y for _, y in seen], pa.int32()),
                "n": pa.array(list(seen.values()), pa.int64()),
            }
        )

    counted = (
        rows.join(F.broadcast(sample), "id", "left")
        .select("text", "toxic")
        .mapInArrow(count, "pattern int, label int, n long")
        .groupBy("pattern", "label")
        .agg(F.sum("n").alias("n"))
        .collect()  # 3 * 2 ** VOTERS rows at most
    )
    model = fit_label_model({(r["pattern"], r["label"]): r["n"] for r in counted})

    # other rows than the lexicons' by and large: their votes must not rest on their own labels
    picked = rows.select("id").orderBy(F.xxhash64(F.col("id"), F.lit(23)), "id").limit(max_fit).distinct()

    @lean
    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            patterns, found = [], []
            for text in batch.column(0).to_pylist():
                pattern, hits = known.votes(text or "")
                patterns.append(pattern)
                found.append(sorted(hits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(patterns, pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                names=["toxic", "pattern", "found"],
            )

    fit_on = (
        rows.join(F.broadcast(picked), "id")
        .join(F.broadcast(sample), "id", "left")
        .select("text", "toxic")
        .mapInArrow(active, "toxic int, pattern int, found array<int>")
        .collect()  # max_fit rows, and repeats of their ids
    )
    targets = np.array([model.target(r["pattern"], r["toxic"]) for r in fit_on])
    weights, bias = fit_linear([r["found"] for r in fit_on], targets, len(lexicon.index), model.prior)
    return ToxicityModel(bare, weights, bias, model)


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    keep: tuple[str | Column, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """The columns ``keep`` with ``score`` (0 to 1) of each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.weights, model.bias))
    rows = docs.select(F.col(text_col).alias("text"), F.struct(*keep).alias("kept"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights, bias = shared.value
        for batch in batches:
            scores = []
            for text in batch.column(0).to_pylist():
                hits = lexicon.read(text or "")[0]
                scores.append(bias + sum(weights[k] for k in sorted(hits)))
            value = 1 / (1 + np.exp(-np.clip(np.array(scores, dtype=np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(value, pa.float64())], names=["kept", "score"]
            )

    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(run, f"kept {kind}, score double").select("kept.*", "score")
