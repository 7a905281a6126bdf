"""Quality rules: counts over whole texts, and a Viterbi labelling of lines as content or boilerplate.

A linear-chain conditional random field over the lines of a text has two labels.  Its weights are
fitted in numpy on a bounded sample of labelled documents.  What is known is the label of a document; the labels of
its lines are latent and estimated by expectation-maximisation.  The share of word characters in
lines that the best label sequence calls content decides whether a document stays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import SMALL_CHUNK_BYTES, PrefixHash, chunks, covered, mixed, word_spans
from sievework.llm.sample import labelled_sample

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
#: Share of word characters in content lines from which a document stays.
MIN_CONTENT = 0.5
#: Rounds of expectation-maximisation, and log odds by which a document's label speaks for that of a line.
ROUNDS = 3
PULL = 0.5
#: Bounds of the sample that the weights are fitted on: documents, and lines of a document (a run from its middle).
SAMPLE_DOCUMENTS = 4_000
SAMPLE_LINES = 200

FEATURES = ["bias", "words", "symbols", "pipes", "upper", "exclamations", "digits", "closed", "long_words", "repeated"]
#: Weights for content of each feature where there is nothing to fit them on.
PLAIN_WEIGHTS = np.array([1.0, 1.0, -8.0, -8.0, -4.0, -4.0, -1.0, 1.0, -1.0, -1.0])
PLAIN_TRANSITIONS = np.array([[1.0, 0.0], [0.0, 1.0]])


@dataclass
class LineModel:
    """Weights of content against boilerplate, and of label pairs (0 boilerplate, 1 content)."""

    weights: np.ndarray
    transitions: np.ndarray


class Lines:
    """Lines with a word of a chunk of documents, and counts of the documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        docs = len(offsets) - 1
        starts, ends, owner = word_spans(data, offsets)
        self.n_words = np.bincount(owner, minlength=docs)
        sums = lambda flags: np.concatenate(([0], np.cumsum(flags)))
        leads = sums((data & 0xC0) != 0x80)
        chars = leads[ends] - leads[starts]
        self.word_chars = np.bincount(owner, chars, docs).astype(np.int64)
        symbols = sums(SYMBOLS[data])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
        # A line runs from the document's start or a \n to the next \n or the document's end.
        breaks = np.flatnonzero(data == 10)
        edges = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], breaks + 1)))
        edges = edges[edges < len(data)]
        stop = np.append(edges[1:], len(data))
        stop -= (data[stop - 1] == 10) if len(edges) else 0
        line = np.searchsorted(edges, starts, "right") - 1
        words = np.bincount(line, minlength=len(edges))
        some = np.flatnonzero(words)
        self.doc = np.searchsorted(offsets, edges[some], "right") - 1
        low, high, words = edges[some], stop[some], words[some]
        prefix = PrefixHash(data)
        content = prefix.ranges(low, high)
        order = np.lexsort((low, content, self.doc))
        same = np.zeros(len(some), bool)
        same[order[1:]] = (content[order[1:]] == content[order[:-1]]) & (self.doc[order[1:]] == self.doc[order[:-1]])
        self.n_dup_lines = np.bincount(self.doc, same, docs).astype(np.int64)
        self.n_repeat_words = self._repeats(prefix, starts, ends, owner, docs)
        self.chars = np.bincount(line, chars, len(edges))[some]
        per = lambda flags: (lambda s: s[high] - s[low])(sums(flags))
        total = np.maximum(self.chars, 1)
        lower = per((data >= 97) & (data <= 122))
        upper = per((data >= 65) & (data <= 90))
        last = data[ends[np.cumsum(words) - 1] - 1] if len(some) else np.zeros(0, np.uint8)
        self.features = np.stack(
            [
                np.ones(len(some)),
                np.minimum(np.log2(1 + words), 6) / 6,
                np.minimum(4 * (symbols[high] - symbols[low]) / total, 1),
                np.minimum(2 * per(data == 124) / np.maximum(words, 1), 1),
                upper / np.maximum(upper + lower, 1),
                np.minimum(per(data == 33) / np.maximum(words, 1), 1),
                np.minimum(4 * per((data >= 48) & (data <= 57)) / total, 1),
                (last == 46) | (last == 63) | (last == 33),
                np.minimum(total / np.maximum(words, 1) / 20, 1),
                same,
            ],
            axis=1,
        ).astype(np.float64)

    @staticmethod
    def _repeats(prefix: PrefixHash, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
        n = len(starts) - REPEAT_WINDOW + 1
        if n <= 0:
            return np.zeros(docs, np.int64)
        one = prefix.ranges(starts, ends)
        window = owner[:n].astype(np.uint64)
        for i in range(REPEAT_WINDOW):
            window = window * np.uint64(0x100000001B3) + one[i : i + n]
            window ^= window >> np.uint64(31)
        window = mixed(window)
        at = np.flatnonzero(owner[:n] == owner[REPEAT_WINDOW - 1 :])
        order = np.argsort(window[at])
        sorted_ = window[at][order]
        twin = np.zeros(len(at), bool)
        twin[1:] = sorted_[1:] == sorted_[:-1]
        twin[:-1] |= twin[1:]
        found = at[order[twin]]
        return np.bincount(owner, covered(found, found + REPEAT_WINDOW, len(owner)), docs).astype(np.int64)


def best_labels(scores: np.ndarray, doc: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Viterbi label of every line; ``scores`` (lines, 2), lines of one document in a row.

    All documents of a chunk advance together, one line per step; the long ones go on alone.
    Of two equal paths the one that stays with boilerplate (label 0) wins.
    """
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    length = np.diff(np.append(first, len(doc)))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    back = np.zeros((len(doc), 2), np.int8)
    labels = np.zeros(len(doc), np.int8)
    best = scores[first].copy()
    steps = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(steps + 1)]
    for t in range(1, steps):
        n = active[t]
        via = best[:n, :, None] + transitions
        choice = via.argmax(axis=1)
        back[first[:n] + t] = choice
        best[:n] = np.take_along_axis(via, choice[:, None, :], 1)[:, 0] + scores[first[:n] + t]
    if steps:
        label = best.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            n = active[t]
            labels[first[:n] + t] = label[:n]
            if t:
                label[:n] = back[first[:n] + t, label[:n]]
    return labels


class _Chains:
    """Lines of many documents side by side: step, document, feature; documents by falling length."""

    def __init__(self, features: list[np.ndarray]):
        self.length = np.array([len(f) for f in features])
        self.x = np.zeros((self.length[0], len(features), len(FEATURES)))
        for i, f in enumerate(features):
            self.x[: len(f), i] = f
        self.active = [int(np.sum(self.length > t)) for t in range(self.length[0] + 1)]

    def marginals(self, w: np.ndarray, trans: np.ndarray, pull: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probability of content of every line, and of the label pairs of it and the line before.

        ``pull`` is added to the content score of all lines of a document.
        """
        x, active = self.x, self.active

        def logsum(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis=axis, keepdims=True)
            return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)

        score = np.zeros(x.shape[:2] + (2,))
        score[..., 1] = x @ w + (0 if pull is None else pull)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[0] = score[0]
        for t in range(1, len(x)):
            n = active[t]
            ahead[t, :n] = logsum(ahead[t - 1, :n, :, None] + trans, 1) + score[t, :n]
        for t in range(len(x) - 2, -1, -1):
            n = active[t + 1]
            behind[t, :n] = logsum(trans + (score[t + 1, :n] + behind[t + 1, :n])[:, None, :], 2)
        norm = logsum(ahead[0] + behind[0], 1)
        content, pairs = np.zeros(x.shape[:2]), np.zeros(x.shape[:2] + (2, 2))
        for t in range(len(x)):
            n = active[t]
            content[t, :n] = np.exp(ahead[t, :n, 1] + behind[t, :n, 1] - norm[:n])
            if t:
                pairs[t, :n] = np.exp(ahead[t - 1, :n, :, None] + trans + (score[t, :n] + behind[t, :n])[:, None, :] - norm[:n, None, None])
        return content, pairs


def fit(features: list[np.ndarray], labels: np.ndarray, rounds: int = ROUNDS, steps: int = 40, rate: float = 0.3, ridge: float = 1e-3) -> LineModel:
    """Weights by expectation-maximisation: line labels are unknown, document labels pull at them.

    The start takes every line for what its document is, each line by itself.  Then, in every round, the
    expected labels of lines and of neighbours are those of the model with the pull of the document's
    label, so a line that looks like the other kind becomes one; the weights follow these
    expectations by gradient steps (Adam).
    """
    if not len(set(labels.tolist())) == 2:
        return LineModel(PLAIN_WEIGHTS, PLAIN_TRANSITIONS)
    order = np.argsort([-len(f) for f in features], kind="stable")
    labels = labels[order].astype(int)
    chains = _Chains([features[i] for i in order])
    inside = np.arange(len(chains.x))[:, None] < chains.length
    # Both classes weigh the same.
    weight = np.where(labels == 1, 0.5 / np.sum(labels == 1), 0.5 / np.sum(labels == 0)) / chains.length
    w, trans = np.zeros(len(FEATURES)), np.zeros((2, 2))
    for turn in range(rounds + 1):
        if turn:
            lines, pairs = chains.marginals(w, trans, PULL * (2 * labels - 1))
        else:
            lines, pairs = np.where(inside, labels, 0.0), None
        moments = [np.zeros(len(FEATURES)), np.zeros((2, 2)), np.zeros(len(FEATURES)), np.zeros((2, 2))]
        for step in range(1, (steps if turn else 8 * steps) + 1):
            # Without pairs every line stands by itself.
            content, model_pairs = chains.marginals(w, trans) if turn else (1 / (1 + np.exp(-(chains.x @ w))), None)
            grad_w = np.einsum("tn,tnf->f", (lines - content) * weight * inside, chains.x) - ridge * w
            grad_t = np.einsum("n,tnij->ij", weight, pairs - model_pairs) - ridge * trans if turn else np.zeros((2, 2))
            for i, (value, grad) in enumerate(((w, grad_w), (trans, grad_t))):
                moments[i] = 0.9 * moments[i] + 0.1 * grad
                moments[i + 2] = 0.99 * moments[i + 2] + 0.01 * grad**2
                value += rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 2] / (1 - 0.99**step)) + 1e-8)
    return LineModel(w, trans)


def fit_on_labels(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> LineModel:
    """Model of a bounded sample: ``SAMPLE_DOCUMENTS`` labelled documents, ``SAMPLE_LINES`` lines of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(0), SMALL_CHUNK_BYTES):
                lines = Lines(data, offsets)
                parts = np.split(lines.features, np.searchsorted(lines.doc, np.arange(1, high - low)))
                parts = [p[max(len(p) - SAMPLE_LINES, 0) // 2 :][:SAMPLE_LINES] for p in parts]
                fits = [len(p) > 0 for p in parts]
                blocks = pa.array([p.tobytes() for p, ok in zip(parts, fits) if ok], pa.binary())
                yield pa.RecordBatch.from_arrays([blocks, batch.column(1).slice(low, high - low).filter(pa.array(fits))], names=["lines", "label"])

    rows = labelled_sample(docs, labels, label, SAMPLE_DOCUMENTS, key, text).select("text", F.col("label").cast("int").alias("label"))
    found = rows.mapInArrow(run, "lines binary, label int").toPandas().sort_values(["lines", "label"])
    features = [np.frombuffer(b, np.float64).reshape(-1, len(FEATURES)) for b in found["lines"]]
    return fit(features, found["label"].to_numpy())


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def judged(data: np.ndarray, offsets: np.ndarray, model: LineModel) -> list[np.ndarray]:
    """Columns of ``SCHEMA`` for a chunk of documents."""
    lines = Lines(data, offsets)
    scores = np.zeros((len(lines.doc), 2))
    scores[:, 1] = lines.features @ model.weights
    content = np.bincount(lines.doc, lines.chars * best_labels(scores, lines.doc, model.transitions), len(offsets) - 1)
    share = content / np.maximum(lines.word_chars, 1)
    failed = (lines.n_words < MIN_WORDS) | (100 * lines.n_repeat_words > MAX_REPEAT_PERCENT * lines.n_words)
    return [lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, failed, ~failed & (share >= MIN_CONTENT), share]


def assess(df: DataFrame, model: LineModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the counts of the base rules, ``content_share`` and the verdict ``kept`` of every row.

    Null, empty and blank texts have no words: they fail the base rules and have share 0.  Rows,
    repeated ones included, are judged one by one; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(1), SMALL_CHUNK_BYTES):
                columns = [batch.column(0).slice(low, high - low), *map(pa.array, judged(data, offsets, model))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *(c.split()[0] for c in SCHEMA.split(", "))])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def passing(df: DataFrame, model: LineModel, text: str = "text") -> DataFrame:
    """The rows of ``df`` that ``assess`` keeps, with all of their columns; nothing is shuffled."""
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(at), SMALL_CHUNK_BYTES):
                yield batch.slice(low, high - low).filter(pa.array(judged(data, offsets, model)[6]))

    return df.mapInArrow(run, df.schema)
