"""Removal of repeated word windows by super-k-mer partitioning.

The minimiser of a window is its ``kmer`` words with the smallest hash.  Consecutive windows of
a document that share a minimiser form a super-k-mer; its words travel as one packed string to
the bucket of the minimiser.  Equal windows have equal minimisers, so they meet in one bucket,
where sorting brings equal windows together and the smallest document of each is read off.

Copies of one super-k-mer inside a chunk of documents are settled before the shuffle (only the
smallest document's ones travel), so a passage that a third of all rows hold reaches its bucket
once per chunk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievework.llm.buffers import PrefixHash, binary_array, chunks, covered, mixed, ragged, word_spans
from sievework.llm.spans import (
    ROUTED,
    WORKED_BYTES,
    Found,
    buckets_each,
    by_bucket,
    cuts_of,
    even_buckets,
    identified,
    owned,
    owners,
    pack,
    pieces,
    routed_batch,
    runs_of,
    same_bytes,
    settled_batch,
    small,
    tagged,
    tags,
    unpack,
    with_spans,
)
from sievework.llm.words import joined_words

FIELDS = ["key", "tag", "doc", "low", "words", "minimiser", "sizes", "text"]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by start."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def minimiser_runs(kmer_hash: np.ndarray, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, end and minimiser place of every super-k-mer.

    ``windows`` marks the starts of windows of ``width`` k-mers; of equal minima the leftmost
    counts, so that the choice depends on the window's content alone.
    """
    place = np.arange(len(kmer_hash), dtype=np.uint64)
    best = sliding_minimum(kmer_hash & ~np.uint64(2**32 - 1) | place, width) & np.uint64(2**32 - 1)
    starts = np.flatnonzero(windows)
    at = best[starts].astype(np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1] + 1 if len(first) else starts, at[first]


def route(buckets: np.ndarray, dests: np.ndarray, window: int, kmer: int):
    """Task that turns documents into packed super-k-mers and settles copies inside a chunk."""

    def work(key: np.ndarray, tag: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
        text, starts, ends, counts = joined_words(data, offsets)
        n = len(starts)
        if n < window:
            return
        doc = np.repeat(np.arange(len(counts)), counts)
        prefix = PrefixHash(text)
        one = prefix.ranges(starts, ends)
        several = np.zeros(n, np.uint64)
        with_all = n - kmer + 1
        several[:with_all] = one[:with_all]
        for i in range(1, kmer):
            several[:with_all] = several[:with_all] * np.uint64(0x100000001B3) + one[i : i + with_all]
        several = mixed(several)
        window_ok = np.zeros(n - window + 1, bool)
        window_ok[:] = doc[: n - window + 1] == doc[window - 1 :]
        first, end, at = minimiser_runs(several, window_ok, window - kmer + 1)
        if not len(first):
            return
        words = end - first + window - 1
        low, high = starts[first], ends[first + words - 1]
        owner, inside = doc[first], first - (np.cumsum(counts) - counts)[doc[first]]
        content, ids = prefix.ranges(low, high), key[owner]
        order = np.lexsort((ids, content))
        copy = first_holders(order, runs_of(content[order]), ids, low, high - low, text)
        gone = order[copy]
        if len(gone):
            yield settled_batch([(ids[gone], tag[owner[gone]], inside[gone], inside[gone] + words[gone])], dests)
        stay = np.ones(len(first), bool)
        stay[gone] = False
        target = ((several[at] >> np.uint64(32)) % np.uint64(len(buckets))).astype(np.int64)
        sent = np.flatnonzero(stay)
        sent = sent[np.argsort(target[sent], kind="stable")]
        goes, blocks = [], []
        for cut in cuts_of(target[sent]):
            r = sent[cut]
            records = {
                "low": small(inside[r]),
                "words": small(words[r]),
                "minimiser": several[at[r]].astype(np.uint32),
                "sizes": small((high - low)[r]),
                "text": ragged(text, low[r], (high - low)[r]),
            }
            blocks.append(pack(owners(r, owner, key, tag) | records))
            goes.append(target[r[0]])
        yield routed_batch(buckets[goes], blocks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tag = batch.column(0).to_numpy(), tags(batch.column(1))
            for low, high, data, offsets in chunks(batch.column(2)):
                yield from work(key[low:high], tag[low:high], data, offsets)

    return run


def first_holders(order: np.ndarray, fresh: np.ndarray, key: np.ndarray, at: np.ndarray, sizes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of sorted records, which equal an earlier one of a smaller key byte by byte."""
    leader = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    copy = (key[order] > key[leader]) & (sizes[order] == sizes[leader])
    copy[copy] &= same_bytes(text, at[order[copy]], at[leader[copy]], sizes[order[copy]])
    return copy


def settle(window: int):
    """Work of a bucket: sort, then read off the smallest document of every window."""

    def work(blocks: list[bytes]) -> Iterator[Found]:
        parts = [unpack(b, FIELDS) for b in blocks]
        doc, keys, named = owned(parts)
        low, words, minimiser, sizes = (np.concatenate([p[f] for p in parts]).astype(np.int64) for f in FIELDS[3:7])
        text = np.concatenate([p["text"] for p in parts])
        del parts
        at = np.cumsum(sizes) - sizes
        order = np.argsort(minimiser, kind="stable")
        # Super-k-mers of one minimiser stay together; the bucket's text is looked at piece by piece.
        for piece in pieces(minimiser[order], sizes[order], WORKED_BYTES):
            r = order[piece]
            yield from settle_piece(keys[doc[r]], named[doc[r]], low[r], words[r], minimiser[r], sizes[r], ragged(text, at[r], sizes[r]), window)

    return work


def settle_piece(key, tag, low, words, minimiser, sizes, text, window) -> Iterator[Found]:
    at = np.cumsum(sizes) - sizes
    content = PrefixHash(text).ranges(at, at + sizes)
    order = np.lexsort((key, content, minimiser))
    fresh = runs_of(minimiser[order], content[order])
    copy = first_holders(order, fresh, key, at, sizes, text)
    gone = order[copy]
    if len(gone):
        yield key[gone], tag[gone], low[gone], low[gone] + words[gone]
    # Different super-k-mers of one minimiser may still share windows: sort those one by one.
    group = np.cumsum(runs_of(minimiser[order])) - 1
    several = np.bincount(group, fresh)[group] > 1
    rest = order[several & ~copy]
    if not len(rest):
        return
    some = ragged(text, at[rest], sizes[rest])
    offsets = np.concatenate(([0], np.cumsum(sizes[rest])))
    starts, ends, owner = word_spans(some, offsets)
    first = np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :])
    begin, size, mine = starts[first], ends[first + window - 1] - starts[first], rest[owner[first]]
    place = low[mine] + first - np.searchsorted(owner, owner[first])
    content = PrefixHash(some).ranges(begin, begin + size)
    order = np.lexsort((key[mine], content))
    copy = first_holders(order, runs_of(content[order]), key[mine], begin, size, some)
    gone = order[copy]
    if len(gone):
        yield key[mine[gone]], tag[mine[gone]], place[gone], place[gone] + window


def kept_words(key: pa.Array, tag: np.ndarray, data: np.ndarray, offsets: np.ndarray, spans: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
    """Rows with the words outside of their spans."""
    text, starts, ends, counts = joined_words(data, offsets)
    begin = np.cumsum(counts) - counts
    keep, removed = np.ones(len(starts), bool), np.zeros(len(counts), np.int64)
    for i, pairs in enumerate(spans):
        if pairs is not None:
            gone = covered(pairs[:, 0], pairs[:, 1], int(counts[i]))
            keep[begin[i] : begin[i] + counts[i]] = ~gone
            removed[i] = gone.sum()
    kept = np.flatnonzero(keep)
    docs = np.repeat(np.arange(len(counts)), counts)[kept]
    # One space after every word but the last of a document.
    last = np.append(docs[1:] != docs[:-1], True)[: len(docs)]
    sizes = ends[kept] - starts[kept] + ~last
    out = binary_array(ragged(text, starts[kept], sizes), np.bincount(docs, sizes, len(counts)).astype(np.int64))
    yield pa.RecordBatch.from_arrays([key, pa.array(counts.astype(np.int64)), pa.array(removed), out.cast(pa.string())], names=["key", "n_words", "n_removed", "kept"])


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, kmer: int = 3) -> DataFrame:
    """``key``, ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one space) of every row.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller
    key.  Null, empty and short texts lose nothing.  Rows of one key and text are one document and get the
    same result each; rows with a null key lose nothing and make others lose nothing.
    """
    rows, dests = identified(tagged(df, key, text)), even_buckets(df, 1)
    keyed = rows.filter("key IS NOT NULL")
    buckets = even_buckets(df, buckets_each(keyed))
    routed = keyed.mapInArrow(route(buckets, dests, window, kmer), ROUTED)
    found = by_bucket(routed, settle(window), dests)
    kept = with_spans(rows, found, dests, kept_words, "key long, n_words long, n_removed long, kept string")
    return kept.withColumnRenamed("key", key)
