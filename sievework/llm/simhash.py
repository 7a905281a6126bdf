"""SimHash fingerprints and near-duplicate groups by a Gray-order hierarchical index.

A fingerprint bit is 1 if it is set in more than half of the hashes of a text's word
shingles.  Two fingerprints are linked at ``radius`` or fewer differing bits.

Distribution: 64 bits are cut into ``radius + j`` blocks.  Two linked fingerprints agree on at
least ``j`` whole blocks, so every fingerprint goes to one bucket per choice of ``j`` blocks and
no link is lost.  ``j`` follows the number of fingerprints so that a bucket of evenly spread
ones stays small; any ``j`` gives the same links.

Inside the buckets: fingerprints are sorted by Gray rank, which brings those with long common
patterns together.  Runs of ``FAN_OUT`` become nodes that hold the bits all of them share, and
again, up to one root per bucket.  A search goes from the root down, adds the differing bits
that each level newly fixes, and drops a whole node once the sum exceeds the radius.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import SMALL_CHUNK_BYTES, chunks
from sievework.llm.graph import components
from sievework.llm.spans import one_row_each, tagged
from sievework.llm.words import joined_words
from sievework.scratch import written

SEED = 42
#: Children of an index node; no effect on results.
FAN_OUT = 8
#: Rows of index work in flight; no effect on results.
FRONTIER = 100_000
#: Bucket size that the choice of blocks aims at for evenly spread fingerprints.
BUCKET_ROWS = 1_000


def chunk_fingerprints(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    text, starts, ends, counts = joined_words(lower, offsets)
    shingles = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    first = np.repeat(np.cumsum(counts) - counts, shingles)
    at = np.arange(len(first)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = first + at + np.repeat(np.minimum(counts, words), shingles) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    low, high = starts[first + at].tolist(), ends[last].tolist()
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(low, high)), np.uint64, len(low))
    result = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        octets, begin = hashes.astype("<u8").view(np.uint8).reshape(-1, 8), (np.cumsum(shingles) - shingles)[some]
        # Eight bits at a time: summing takes a copy of eight bytes for each bit.
        bits = (np.unpackbits(octets[:, [i]], axis=1, bitorder="little") for i in range(8))
        sums = np.concatenate([np.add.reduceat(b, begin, axis=0, dtype=np.int64) for b in bits], axis=1)
        result[some] = np.packbits(2 * sums > shingles[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """``key`` and ``fp`` (long) of every row; a text without words has fingerprint zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chunk_fingerprints(data, offsets, words) for _, _, data, offsets in chunks(batch.column(1), SMALL_CHUNK_BYTES)]
            values = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["key", "fp"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of a code word in the reflected Gray sequence."""
    for step in (1, 2, 4, 8, 16, 32):
        fps = fps ^ (fps >> np.uint64(step))
    return fps


class GrayIndex:
    """Index of fingerprints that are sorted by bucket and Gray rank."""

    def __init__(self, buckets: np.ndarray, fps: np.ndarray):
        n = len(fps)
        mask, pattern, bucket = np.full(n, ~np.uint64(0)), fps, buckets
        self.fps = fps
        #: From the leaves up: shared bits, their pattern, first child, end of children, end of leaves.
        self.levels = [(mask, pattern, None, None, np.arange(1, n + 1))]
        while len(bucket) and (bucket[1:] == bucket[:-1]).any():
            fresh = np.concatenate(([True], bucket[1:] != bucket[:-1]))
            inside = np.arange(len(bucket)) - np.maximum.accumulate(np.where(fresh, np.arange(len(bucket)), 0))
            first = np.flatnonzero(inside % FAN_OUT == 0)
            end = np.append(first[1:], len(bucket))
            ones, any_ = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
            mask = np.bitwise_and.reduceat(mask, first) & ~(ones ^ any_)
            pattern, bucket = ones & mask, bucket[first]
            self.levels.append((mask, pattern, first, end, self.levels[-1][4][end - 1]))
        self.root_of = np.repeat(np.arange(len(bucket)), np.diff(np.concatenate(([0], self.levels[-1][4])))) if n else np.zeros(0, np.int64)

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places of linked fingerprints of one bucket, each once."""
        top = len(self.levels) - 1
        mask, pattern, *_ = self.levels[top]
        queries = np.arange(len(self.fps))
        apart = np.bitwise_count((self.fps ^ pattern[self.root_of]) & mask[self.root_of])
        stack = [(top, queries, self.root_of, apart)]
        while stack:
            level, q, node, apart = stack.pop()
            if len(q) > FRONTIER:
                stack += [(level, q[i : i + FRONTIER], node[i : i + FRONTIER], apart[i : i + FRONTIER]) for i in range(0, len(q), FRONTIER)]
                continue
            if level == 0:
                some = q < node
                yield q[some], node[some]
                continue
            above, _, first, end, _ = self.levels[level]
            mask, pattern, _, _, last = self.levels[level - 1]
            width = end[node] - first[node]
            child = np.arange(int(width.sum())) + np.repeat(first[node] - np.cumsum(width) + width, width)
            q, fixed, apart = np.repeat(q, width), np.repeat(above[node], width), np.repeat(apart, width)
            apart = apart + np.bitwise_count((self.fps[q] ^ pattern[child]) & mask[child] & ~fixed)
            near = (apart <= radius) & (last[child] > q + 1 - (level > 1))
            if near.any():
                stack.append((level - 1, q[near], child[near], apart[near]))


def group_minima(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest place that each place is connected to."""
    label = np.arange(n)
    for a, b in links:
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    return label


def bucket_keys(fp: Column, radius: int, rows: int) -> tuple[Column, int]:
    """Array of bucket keys of a fingerprint, and how many blocks each takes."""
    j = next(j for j in range(1, 64) if rows <= BUCKET_ROWS * 2 ** (64 * j / (radius + j)) or radius + j == 64)
    cuts = [64 * i // (radius + j) for i in range(radius + j + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(radius + j), j)):
        mask = sum((1 << cuts[i + 1]) - (1 << cuts[i]) for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(signed))))
    return F.array(*keys), j


def linked_groups(distinct: DataFrame, radius: int) -> DataFrame:
    """Star edges ``a``, ``b`` that connect what is linked inside a bucket.

    A bucket is one key of ``bucket_keys``; buckets stream through a task, so its memory is
    that of the largest bucket.
    """
    keys, _ = bucket_keys(F.col("fp"), radius, distinct.count())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in _with_end(batches):
            if batch is not None:
                held_key = np.concatenate((held_key, batch.column(0).to_numpy()))
                held_fp = np.concatenate((held_fp, batch.column(1).to_numpy()))
                if len(held_key) < FRONTIER or held_key[0] == held_key[-1]:
                    continue
                cut = int(np.searchsorted(held_key, held_key[-1]))
            else:
                cut = len(held_key)
            key, fp = held_key[:cut], held_fp[:cut].view(np.uint64)
            held_key, held_fp = held_key[cut:], held_fp[cut:]
            order = np.lexsort((gray_rank(fp), key))
            key, fp = key[order], fp[order]
            label = group_minima(len(fp), GrayIndex(key, fp).links(radius))
            moved = label != np.arange(len(fp))
            yield pa.RecordBatch.from_arrays([pa.array(fp[moved].view(np.int64)), pa.array(fp[label[moved]].view(np.int64))], names=["a", "b"])

    rows = distinct.select(F.explode(keys).alias("bucket"), "fp")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")


def _with_end(batches: Iterable) -> Iterator:
    yield from batches
    yield None


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (smallest key reachable) of every row.

    Null and empty texts have fingerprint zero and are linked like any other.  Repeated rows stay repeated.
    A null key never is a component's number; a component of null keys only has a null one.
    Copies are one fingerprint from the start and are never expanded into pairs.
    """
    docs = written(fingerprints(df, key, text, words), "fingerprints")
    nodes = written(docs.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    roots = components(linked_groups(nodes.select("fp"), radius)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = written(placed, "rooted-fingerprints")
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return docs.join(placed.select("fp", "root").join(lowest, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each group the document with the smallest key stays.

    Rows of one key and text are one document, of which one row stays; of documents of one key
    and group the one with the smallest text hash does.  Rows with a null key stay: no decision can name them.
    """
    rows = tagged(df, key, text)
    named = rows.select(F.when(F.col("key").isNotNull(), F.struct("key", "tag")).alias("document"), "text")
    found = near_duplicates(named, "document", "text", words, radius)
    dropped = found.filter(F.col("document") != F.col("component_id")).select("document.key", "document.tag").distinct()
    return one_row_each(df, written(dropped, "near-duplicates"), key, text)
