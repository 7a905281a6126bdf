"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on a document.  How often each vote
pattern occurs is counted over all documents (at most 3 to the number of labellers patterns).
Expectation-maximisation on these counts estimates, without any given label, how good documents and
bad ones differ in the votes of each labeller, and the posterior of each pattern.  Posterior labels
of a bounded sample train a linear scorer on hashed features (byte n-grams and levels of the measures), which then scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import SPACE, PrefixHash, chunks, mixed, word_spans
from sievework.llm.sample import labelled_sample

#: Labellers: measure, votes bad from the first bound on, good up to the second, nothing between.
LABELLERS = {
    "symbol_share": (0.08, 0.005),
    "symbol_words": (0.30, 0.02),
    "bar_share": (0.20, 0.01),
    "upper_share": (0.50, 0.15),
    "exclamations": (0.30, 0.02),
    "repeated_triples": (0.30, 0.10),
    "repeated_fives": (0.20, 0.05),
    "echoes": (0.20, 0.05),
    "unclosed_lines": (0.90, 0.40),
    "shortness": (0.10, 0.025),
}
#: Hashed features and the n-gram they stand for.
BUCKETS = 1 << 13
GRAM = 4
#: Steps of a measure as a feature, and the value of such a feature (an n-gram's is its share).
LEVELS = 4
LEVEL_SHARE = 0.1
#: Bound of the sample that the scorer is trained on.
SAMPLE_DOCUMENTS = 3_000
#: Score from which a document stays.
MIN_SCORE = 0.5

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WORD_END = np.zeros(256, bool)
WORD_END[list(b"#*$%&|<>!")] = True


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What the labellers look at, one column each, of every document."""
    n = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    words = np.maximum(np.bincount(owner, minlength=n), 1)
    sums = lambda flags: (lambda s: (s[offsets[1:]] - s[offsets[:-1]]).astype(float))(np.concatenate(([0], np.cumsum(flags))))
    full = np.maximum(sums(~SPACE[data]), 1)
    upper, lower = sums((data >= 65) & (data <= 90)), sums((data >= 97) & (data <= 122))
    content = PrefixHash(data).ranges(starts, ends)
    echo = np.zeros(len(owner), bool)
    echo[1:] = (content[1:] == content[:-1]) & (owner[1:] == owner[:-1])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    line_end = np.zeros(len(owner), bool)
    if len(owner):
        breaks = np.concatenate(([0], np.cumsum(data == 10)))
        line_end[:-1] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (owner[1:] != owner[:-1])
        line_end[-1] = True
    closed = (last == 46) | (last == 63)
    lines = np.maximum(np.bincount(owner, line_end, n), 1)
    return np.stack(
        [
            sums(SYMBOLS[data]) / full,
            np.bincount(owner, WORD_END[last], n) / words,
            sums(data == 124) / words,
            upper / np.maximum(upper + lower, 1),
            np.bincount(owner, last == 33, n) / words,
            repeated(content, owner, 3, n) / words,
            repeated(content, owner, 5, n) / words,
            np.bincount(owner, echo, n) / words,
            np.bincount(owner, line_end & ~closed, n) / lines,
            1 / words,
        ],
        axis=1,
    )


def repeated(content: np.ndarray, owner: np.ndarray, width: int, docs: int) -> np.ndarray:
    """Windows of ``width`` words that an earlier one of the document equals."""
    n = len(content) - width + 1
    if n <= 0:
        return np.zeros(docs)
    window = owner[:n].astype(np.uint64)
    for i in range(width):
        window = mixed(window + content[i : i + n])
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    order = at[np.argsort(window[at], kind="stable")]
    again = order[1:][window[order[1:]] == window[order[:-1]]]
    return np.bincount(owner[again], minlength=docs)


def vote_patterns(values: np.ndarray) -> np.ndarray:
    """Votes of all labellers as one base-3 number: 0 nothing, 1 good, 2 bad."""
    bounds = np.array(list(LABELLERS.values()))
    votes = np.where(values >= bounds[:, 0], 2, np.where(values <= bounds[:, 1], 1, 0))
    return votes @ (3 ** np.arange(len(LABELLERS)))


def unfolded(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class LabelModel:
    """Share of good documents, and vote shares by labeller, class (0 bad, 1 good) and vote."""

    good: float
    votes: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        votes = unfolded(patterns)
        log = np.log([1 - self.good, self.good]) + sum(np.log(self.votes[i][:, votes[:, i]].T) for i in range(votes.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))

    def accuracies(self) -> pd.DataFrame:
        """How often the vote of each labeller is right, where it votes."""
        right = (1 - self.good) * self.votes[:, 0, 2] + self.good * self.votes[:, 1, 1]
        voted = (1 - self.good) * self.votes[:, 0, 1:].sum(1) + self.good * self.votes[:, 1, 1:].sum(1)
        return pd.DataFrame({"labeller": list(LABELLERS), "accuracy": right / voted, "coverage": voted})


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation on pattern counts, started from the majority of bad votes.

    A start that takes one bad vote as a sign of a bad document breaks the symmetry of the classes;
    ``labels`` tables are never read.
    """
    votes = unfolded(patterns)
    good = np.where((votes == 2).sum(1) > 0, 0.1, 0.95)
    model = LabelModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3))
    for _ in range(rounds if len(patterns) else 0):
        weight = np.stack(((1 - good) * counts, good * counts))
        share = (weight.sum(1) + 1) / (weight.sum() + 2)
        table = np.stack([[np.bincount(votes[:, i], w, 3) + 0.5 for w in weight] for i in range(len(LABELLERS))])
        model = LabelModel(float(np.clip(share[1], 1e-3, 1 - 1e-3)), table / table.sum(axis=2, keepdims=True))
        new = model.posterior(patterns)
        if np.abs(new - good).max() < 1e-6:
            break
        good = new
    return model


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Probability of good for every document, from its n-grams and its measures."""
        gram = grams(data)
        sums = np.concatenate(([0.0], np.cumsum(self.weights[gram], dtype=np.float64)))
        low, high = np.minimum(offsets[:-1], len(gram)), np.minimum(np.maximum(offsets[1:] - GRAM + 1, offsets[:-1]), len(gram))
        text = (sums[high] - sums[low]) / np.maximum(high - low, 1)
        return 1 / (1 + np.exp(-np.clip(self.bias + text + LEVEL_SHARE * self.weights[levels(values)].sum(axis=1), -500, 500)))


def grams(data: np.ndarray) -> np.ndarray:
    """Hash bucket of every n-gram."""
    return (PrefixHash(data).windows(GRAM)[: max(len(data) - GRAM + 1, 0)] >> np.uint64(40)).astype(np.int64) % BUCKETS


def levels(values: np.ndarray) -> np.ndarray:
    """Hash bucket of the level of every measure, between what is good and what is bad."""
    bounds = np.array(list(LABELLERS.values()))
    level = np.floor(LEVELS * np.clip((values - bounds[:, 1]) / (bounds[:, 0] - bounds[:, 1]), 0, 1)).astype(np.uint64)
    return (mixed(level + np.uint64(LEVELS + 1) * np.arange(1, len(bounds) + 1).astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def train(x: np.ndarray, good: np.ndarray, steps: int = 200, rate: float = 5.0, ridge: float = 1e-6) -> Scorer:
    """Logistic regression on n-gram shares against posterior labels, by Adam."""
    w, bias = np.zeros(BUCKETS), 0.0
    if not len(x):
        return Scorer(w, bias)
    rare = min(good.sum(), (1 - good).sum())
    weight = np.where(good > 0.5, 0.5 / max(good.sum(), 1e-9), 0.5 / max((1 - good).sum(), 1e-9)) if rare > 1e-6 else np.full(len(good), 1 / len(good))
    first, second = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, steps + 1):
        error = weight * (good - 1 / (1 + np.exp(-np.clip(x @ w + bias, -500, 500))))
        grad = np.append(error.astype(np.float32) @ x - ridge * w, error.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        move = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = w + rate * move[:-1], bias + rate / 50 * move[-1]
    return Scorer(w, bias)


def pattern_counts(df: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Every vote pattern and its count over all rows; added up before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                found, n = np.unique(vote_patterns(measures(data, offsets)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    rows = df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "pattern long, n long")
    found = rows.groupBy("pattern").agg(F.sum("n").alias("n")).toPandas().sort_values("pattern")
    return found["pattern"].to_numpy(np.int64), found["n"].to_numpy(np.float64)


def train_on_posteriors(df: DataFrame, model: LabelModel, key: str = "doc_id", text: str = "text") -> Scorer:
    """Scorer of at most ``SAMPLE_DOCUMENTS`` documents, chosen by a hash of the key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(0)):
                values = measures(data, offsets)
                good, level = model.posterior(vote_patterns(values)), levels(values)
                gram, blocks = grams(data), []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    found = gram[a : max(b - GRAM + 1, a)]
                    share = np.concatenate((np.full(len(found), 1 / max(len(found), 1)), np.full(len(LABELLERS), LEVEL_SHARE)))
                    at, place = np.unique(np.concatenate((found, level[i])), return_inverse=True)
                    blocks.append(at.astype(np.int32).tobytes() + np.bincount(place, share).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary()), pa.array(good)], names=["grams", "good"])

    keys = df.select(F.col(key).alias("key"), F.lit(1).alias("label"))
    rows = labelled_sample(df.select(F.col(key).alias("key"), F.col(text).alias("text")), keys, "label", SAMPLE_DOCUMENTS, "key")
    found = rows.select("text").mapInArrow(run, "grams binary, good double").toPandas().sort_values(["grams", "good"])
    x = np.zeros((len(found), BUCKETS), np.float32)
    for row, block in zip(x, found["grams"]):
        half = len(block) // 2
        row[np.frombuffer(block[:half], np.int32)] = np.frombuffer(block[half:], np.float32)
    return train(x, found["good"].to_numpy())


def classify(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``posterior`` (of the labellers), ``score`` (of the scorer) and ``kept`` of every row.

    Null and empty texts have no words: the labellers find them short, the scorer has nothing to go
    by, and they are not kept.  Rows, repeated ones included, are scored one by one.
    """
    model = estimate(*pattern_counts(df, text))
    scorer = train_on_posteriors(df, model, key, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(1)):
                values = measures(data, offsets)
                posterior, score = model.posterior(vote_patterns(values)), scorer.score(data, offsets, values)
                some = np.bincount(word_spans(data, offsets)[2], minlength=high - low) > 0
                kept = (score >= MIN_SCORE) & some
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(posterior), pa.array(score), pa.array(kept)], names=["key", "posterior", "score", "kept"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, posterior double, score double, kept boolean").withColumnRenamed("key", key)
