"""Whole texts as numpy byte buffers inside Arrow batches.

A text column arrives as one byte buffer and offsets.  Operators work on chunks of whole
documents of about ``CHUNK_BYTES``, so memory is bounded by the chunk or, for a longer
document, by that document.  A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; no effect on results.
CHUNK_BYTES = 2 << 20
#: The same where the tables of a chunk are very many times its text.
SMALL_CHUNK_BYTES = 1 << 19
#: Values that ``ragged`` gathers at once: their places take eight bytes each, several times over.
GATHERED = 1 << 18

#: ASCII white space: the complement of the word pattern ``[^\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a string or binary column."""
    kind = pa.binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.string()
    column = pc.fill_null(column.cast(kind), b"" if kind == pa.binary() else "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of runs of whole documents."""
    yield from whole_documents(*text_buffer(column), size)


def whole_documents(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same of a buffer: ``size`` bytes at most, or one longer document."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; words never cross documents."""
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], word))[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.concatenate((word, [False]))[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h >> np.uint64(32) ^ h
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


class PrefixHash:
    """64-bit hashes of any byte ranges of one buffer, from prefix sums of a polynomial.

    The tables are the same in every process, so hashes of different tasks compare.
    """

    _rng = np.random.Generator(np.random.PCG64(20_240_607))
    _letters = _rng.integers(1, 2**64 - 1, 256, np.uint64)
    _base = np.uint64(0x9E3779B97F4A7C15 | 1)
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) > n:
            return
        n = next((size for size in (SMALL_CHUNK_BYTES, CHUNK_BYTES) if n <= size), n) + 1
        inverse = np.uint64(pow(int(cls._base), -1, 2**64))
        cls._powers, cls._inverse = np.full(n, cls._base), np.full(n, inverse)
        for table in (cls._powers, cls._inverse):
            table[0] = 1
            np.cumprod(table, out=table)

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._grow(n)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = self._letters[data]
        terms *= self._powers[:n]
        np.cumsum(terms, out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every ``[start, end)``."""
        return mixed((self.sums[ends] - self.sums[starts]) * self._inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hash of every window of ``width`` bytes, by start."""
        n = max(len(self.sums) - width, 0)
        found = self.sums[width:] - self.sums[:n]
        found *= self._inverse[:n]
        return mixed(found)


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[start : start + length]`` for all ranges."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    out, ends = np.empty(total, values.dtype), np.cumsum(lengths)
    low, done = 0, 0
    while low < len(lengths):
        high = max(int(np.searchsorted(ends, done + GATHERED, "right")), low + 1)
        size, stop = lengths[low:high], int(ends[high - 1])
        at = np.repeat(starts[low:high] - (ends[low:high] - size), size)
        at += np.arange(done, stop)
        out[done:stop] = values[at]
        low, done = high, stop
    return out


def covered(lows: np.ndarray, highs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any ``[low, high)``."""
    steps = np.bincount(lows, minlength=n + 1) - np.bincount(highs, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
