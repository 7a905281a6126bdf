"""Language of a text by a byte convolutional network.

Bytes are embedded, filters of several widths slide over a window of fixed length, the largest
answer of each filter in the window is kept, and a softmax layer turns these into languages.
Training runs in numpy on a bounded sample of labelled windows.  A text is cut into consecutive
windows, all of which are classified; their probabilities are averaged by length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import chunks
from sievework.llm.sample import labelled_sample

WINDOW = 64
EMBEDDED = 8
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bounds of the training sample: documents, and windows of each, spread over the whole text.
SAMPLE_DOCUMENTS = 3_000
SAMPLE_WINDOWS = 6
EPOCHS = 6
BATCH = 128
#: Windows classified at once; no effect on results.
BLOCK = 2_048


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows (zero-padded), their documents and their bytes of text."""
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[doc] + number * WINDOW
    length = np.minimum(offsets[doc + 1] - start, WINDOW)
    padded = np.concatenate((data, np.zeros(WINDOW, np.uint8)))
    out = padded[start[:, None] + np.arange(WINDOW)]
    out[np.arange(WINDOW) >= length[:, None]] = 0
    return out, doc, length


class ByteNetwork:
    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        reach, units = max(WIDTHS), FILTERS * len(WIDTHS)
        #: A narrow filter is a wide one with zero weights beyond its width.
        self.shape = np.repeat([[w > i for i in range(reach) for _ in range(EMBEDDED)] for w in WIDTHS], FILTERS, axis=0).T.astype(np.float32)
        scale = lambda *size: (rng.standard_normal(size) * 0.3).astype(np.float32)
        self.values = {"embed": scale(256, EMBEDDED), "filters": scale(reach * EMBEDDED, units) * self.shape, "shift": np.zeros(units, np.float32), "out": scale(units, len(languages)), "bias": np.zeros(len(languages), np.float32)}

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reach = max(WIDTHS)
        x = self.values["embed"][windows]
        n, places = len(x), WINDOW - reach + 1
        flat = np.lib.stride_tricks.sliding_window_view(x.reshape(n, -1), reach * EMBEDDED, axis=1)[:, ::EMBEDDED]
        answers = flat.reshape(n * places, -1) @ self.values["filters"]
        answers = answers.reshape(n, places, -1)
        return flat, answers, answers.max(axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), BLOCK):
            top = np.maximum(self._pooled(windows[i : i + BLOCK])[2] + self.values["shift"], 0)
            z = top @ self.values["out"] + self.values["bias"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[i : i + BLOCK] = z / z.sum(axis=1, keepdims=True)
        return out

    def _gradients(self, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        v, n, reach = self.values, len(windows), max(WIDTHS)
        flat, answers, top = self._pooled(windows)
        place = answers.argmax(axis=1)
        hidden = np.maximum(top + v["shift"], 0)
        z = hidden @ v["out"] + v["bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        slope = z / z.sum(axis=1, keepdims=True)
        slope[np.arange(n), target] -= 1
        slope *= (weight / weight.sum())[:, None]
        back = (slope @ v["out"].T) * (hidden > 0)
        found = flat[np.arange(n)[:, None], place]
        grad_filters = np.einsum("nuk,nu->ku", found, back) * self.shape
        grad_embed = np.zeros_like(v["embed"])
        spread = (back[:, :, None] * v["filters"].T[None]).reshape(n, -1, reach, EMBEDDED)
        at = windows[np.arange(n)[:, None, None], place[:, :, None] + np.arange(reach)]
        np.add.at(grad_embed, at.ravel(), spread.reshape(-1, EMBEDDED))
        return {"embed": grad_embed, "filters": grad_filters, "shift": back.sum(0), "out": hidden.T @ slope, "bias": slope.sum(0)}

    def fit(self, windows: np.ndarray, target: np.ndarray, seed: int = 5, rate: float = 0.01) -> ByteNetwork:
        """Adam on shuffled batches; every language weighs the same."""
        rng = np.random.default_rng(seed)
        weight = (1 / np.maximum(np.bincount(target, minlength=len(self.languages)), 1))[target].astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.values.items()}
        second = {k: np.zeros_like(v) for k, v in self.values.items()}
        step = 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(len(target)), -(-len(target) // BATCH)):
                step += 1
                for k, g in self._gradients(windows[rows], target[rows], weight[rows]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    self.values[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def train(df: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteNetwork:
    """Network of at most ``SAMPLE_DOCUMENTS`` usable documents with a language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(0)):
                windows, doc, _ = windows_of(data, offsets)
                count = np.bincount(doc, minlength=high - low)[doc]
                number = np.arange(len(doc)) - np.searchsorted(doc, doc)
                some = number * SAMPLE_WINDOWS // count != (number - 1) * SAMPLE_WINDOWS // count
                label = batch.column(1).slice(low, high - low).take(pa.array(doc[some]))
                yield pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in windows[some]], pa.binary()), label], names=["window", "lang"])

    learned = df.filter(usable & F.col(lang).isNotNull() & F.col(text).isNotNull())
    keys = learned.select(F.col(key).alias("key"), F.col(lang).alias("label"))
    rows = labelled_sample(learned.select(F.col(key).alias("key"), F.col(text).alias("text")), keys, "label", SAMPLE_DOCUMENTS, "key")
    found = rows.select("text", "label").mapInArrow(run, "window binary, lang string").toPandas().sort_values(["window", "lang"])
    languages = sorted(found["lang"].unique())
    if not languages:
        return ByteNetwork([])
    windows = np.frombuffer(b"".join(found["window"]), np.uint8).reshape(-1, WINDOW)
    return ByteNetwork(languages).fit(windows, np.searchsorted(languages, found["lang"].to_numpy()))


def identify(df: DataFrame, network: ByteNetwork, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row, from the whole text alone.

    A null text, and one without a letter, is ``und`` with score 0, as is every text where nothing was
    learned.  Of equal scores the first language by name wins.  Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(1)):
                total = np.zeros((high - low, max(len(network.languages), 1)))
                windows, doc, length = windows_of(data, offsets)
                some = np.flatnonzero(np.diff(offsets))
                if len(windows) and network.languages:
                    weighted = network.probabilities(windows) * length[:, None]
                    first = np.searchsorted(doc, some)
                    total[some] = np.add.reduceat(weighted, first, axis=0) / np.diff(offsets)[some, None]
                best = total.argmax(axis=1)
                names = pa.array([network.languages[b] if network.languages else None for b in best], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), names, pa.array(np.clip(total.max(axis=1), 0, 1))], names=["key", "lettered", "lang", "score"])

    kind = df.schema[key].dataType.simpleString()
    whole = F.col(text).cast("string")
    rows = df.select(F.col(key).alias("key"), whole.alias("text"), F.coalesce(whole.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    found = rows.mapInArrow(run, f"key {kind}, lettered boolean, lang string, score double")
    known = F.col("lettered") & F.col("lang").isNotNull()
    return found.select(F.col("key").alias(key), F.when(known, F.col("lang")).otherwise("und").alias("lang_pred"), F.when(known, F.col("score")).otherwise(0.0).alias("score"))
