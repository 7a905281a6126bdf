"""Words of whole texts with white space evened out."""

from __future__ import annotations

import numpy as np

from sievework.llm.buffers import ragged, word_spans


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all documents, each followed by one space: bytes, starts, ends, words per document."""
    starts, ends, docs = word_spans(data, offsets)
    lengths = ends - starts
    first = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    out[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = ragged(data, starts, lengths)
    return out, first, first + lengths, np.bincount(docs, minlength=len(offsets) - 1)
