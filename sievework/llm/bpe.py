"""Byte-level BPE with a sentencepiece model that is written from the rank file.

A rank file lists byte strings by merge rank.  Every byte becomes one character, a piece is
the mapped byte string, its score the negative rank, so that the highest score is the lowest
rank; the normaliser is the identity.  The model is serialised here, never trained.  Texts
are cut by the pre-token pattern, each pre-token is encoded by itself, and ids are decoded by
the inverse mapping.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import binary_array, list_array, ragged

#: Byte b travels as the character of this code point plus b.
FIRST_CHARACTER = 0x100
#: Piece of the unknown id that the format asks for; no mapped text contains it.
UNKNOWN = ""
#: Pre-tokens remembered by a task; no effect on results.
CACHE_ENTRIES = 300_000
#: Texts above this many characters are cut into pre-tokens piecemeal; no effect on results.
LONG_TEXT = 1 << 20
BLOCK = 1 << 16

_TO_CHARACTERS = {b: chr(FIRST_CHARACTER + b) for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Byte strings of a rank file in the order of their ranks."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, file))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One field of a protocol-buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value & (1 << 64) - 1)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARACTERS)


def serialised_model(tokens: list[bytes]) -> bytes:
    """A BPE model whose id is the rank plus one (id 0: unknown)."""
    # Fixed values of the public model format: field numbers; kinds 1 normal, 2 unknown; model kind 2 is BPE.
    unknown = _field(1, UNKNOWN) + _field(2, 0.0) + _field(3, 2)
    pieces = [_field(1, mapped(t)) + _field(2, -float(rank)) + _field(3, 1) for rank, t in enumerate(tokens)]
    training = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, 0) + b"".join(_field(n, -1) for n in (41, 42, 43)) + _field(45, UNKNOWN)
    normaliser = _field(1, "identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(_field(1, p) for p in [unknown, *pieces]) + _field(2, training) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(tokens))
        self.cut = regex.compile(pattern)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        codec = self

        class Cache(dict):
            def __missing__(self, piece: str) -> bytes:
                if len(self) >= CACHE_ENTRIES:
                    self.clear()
                ids = self[piece] = codec._piece(piece)
                return ids

        self.cache = Cache()

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        ids = np.array(self.model.encode(mapped(raw)), np.int32) - 1 if rank is None else np.array([rank], np.int32)
        if (ids < 0).any():
            raise ValueError("the rank file lacks single bytes")
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without special tokens."""
        if len(text) <= LONG_TEXT:
            return np.frombuffer(b"".join(map(self.cache.__getitem__, self.cut.findall(text))), np.int32)
        found = (m.group() for m in self.cut.finditer(text))
        blocks = iter(lambda: b"".join(map(self.cache.__getitem__, islice(found, BLOCK))), b"")
        return np.frombuffer(b"".join(blocks), np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids."""
        return ragged(self.bytes, self.starts[ids], self.lengths[ids])


def encode(df: DataFrame, tokens: list[bytes], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of int) and ``decoded`` (bytes that the ids stand for) of every row.

    A null text is an empty one and gives no ids.  Rows, repeated ones included, stay as they
    are; other columns are not read, so their names cannot clash.  One narrow stage: the
    vocabulary goes to the tasks once, its size is that of the rank file.
    """
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            # A few megabytes of text at a time, whole documents.
            low = 0
            texts = batch.column(1)
            while low < len(texts):
                high, size, ids, decoded = low, 0, [], []
                while high < len(texts) and size < LONG_TEXT:
                    found = codec.encode(texts[high].as_py() or "")
                    ids.append(found)
                    decoded.append(codec.decode(found))
                    size += len(decoded[-1])
                    high += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        list_array(np.concatenate(ids), np.fromiter(map(len, ids), np.int64), pa.int32()),
                        binary_array(np.concatenate(decoded), np.fromiter(map(len, decoded), np.int64)),
                    ],
                    names=["key", "ids", "decoded"],
                )
                low = high

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)
