"""Removal of repeated byte strings by a distributed, sampled suffix array.

Which suffixes: of the ``window`` bytes at any place, the ``kmer`` bytes with the smallest hash
are the anchor.  Equal strings have equal anchors, so the suffixes that start at anchors (about
one place in eighteen) are enough to find every repeated string.  A suffix record holds the text
around its anchor that the strings with this anchor reach: to the right the suffix itself, to
the left what precedes it.

1. Anchors whose hash occurs in one document only are left out: hashes of 24 bits and the bucket
   travel, numbers of shared ones come back.  False hits only cost time.
2. Splitters sampled from the leading tokens (8 bytes) of suffixes cut their order into ranges;
   records travel to the range that they fall in.
3. A bucket sorts its suffixes by multikey quicksort, a token of 8 bytes at a time, where only
   what is still tied goes on to the next token.  Neighbours in this order give the longest common
   prefixes; records that reach ``window`` bytes with no other one, left and right together, drop
   out.  The strings of the others are sorted the same way, and equal ones stand side by side.
   Splitters are whole tokens, so that suffixes on the two sides of a boundary differ in the token
   that was compared there: no equal run crosses it.

Copies of one record inside a chunk of documents are settled before each shuffle, so a passage
that a third of all rows hold reaches a bucket once per chunk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import SMALL_CHUNK_BYTES, PrefixHash, binary_array, chunks, covered, ragged, whole_documents
from sievework.llm.spans import (
    ROUTED,
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
    settled_batch,
    small,
    tagged,
    tags,
    unpack,
    unused,
    with_spans,
)
from sievework.llm.superkmer import first_holders, minimiser_runs

#: Documents, and suffixes of each, whose leading tokens are sampled for the splitters; they only
#: steer how even the ranges are.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_SUFFIXES = 32
TOKEN = 8
#: Records sorted, and strings that they are expanded into, at once; no effect on results.
SORTED = 40_000
EXPANDED = 100_000
#: Tokens read at once; no effect on results.
READ = 1 << 14
#: Bits of an anchor hash that travel, beside those that choose the bucket; a bucket's share of the
#: anchors is bounded by its bytes of text, so about one in twenty is a false hit at any size.
HASH_BITS = 24

HASH_FIELDS = ["key", "tag", "doc", "nobody", "low", "high_bits", "low_bits"]
TEXT_FIELDS = ["key", "tag", "doc", "low", "anchor", "sizes", "text"]


class Anchors:
    """Runs of strings with one anchor, in a chunk of documents.

    They are read off smaller chunks, as the tables of hashes are very many times their text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, kmer: int):
        found = [self._runs(some, ends, window, kmer, low, int(offsets[low])) for low, _, some, ends in whole_documents(data, offsets, SMALL_CHUNK_BYTES)]
        found = found or [self._runs(data, offsets, window, kmer, 0, 0)]
        #: Text of a run, its anchor, hashes of anchor and text, its document, its number and place in the document.
        self.first, self.end, self.at, self.hash, self.content, self.doc = (np.concatenate(x) for x in zip(*found))
        self.number = np.arange(len(self.doc)) - np.searchsorted(self.doc, self.doc)
        self.inside = self.first - offsets[self.doc]

    @staticmethod
    def _runs(data: np.ndarray, offsets: np.ndarray, window: int, kmer: int, doc: int, place: int) -> tuple[np.ndarray, ...]:
        n = max(len(data) - window + 1, 0)
        none = np.zeros(0, np.int64)
        if not n:
            return none, none, none, none.view(np.uint64), none.view(np.uint64), none
        inside = np.zeros(n, bool)
        starts = offsets[:-1]
        some = np.diff(offsets) >= window
        steps = np.zeros(n + 1, np.int8)
        steps[starts[some]] += 1
        steps[offsets[1:][some] - window + 1] -= 1
        inside[:] = np.cumsum(steps)[:n] > 0
        prefix = PrefixHash(data)
        hashes = prefix.windows(kmer)
        first, end, at = minimiser_runs(hashes, inside, window - kmer + 1)
        end = end + window - 1
        return first + place, end + place, at + place, hashes[at], prefix.ranges(first, end), np.searchsorted(offsets, first, "right") - 1 + doc


def tokens(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, count: int) -> np.ndarray:
    """``count`` tokens of 8 bytes from each start, big end first, zeros beyond the length."""
    out = np.zeros((count, len(starts)), np.uint64)
    if not len(data):
        return out
    for low in range(0, len(starts), READ):
        some = slice(low, low + READ)
        for i in range(count):
            place = np.arange(i * TOKEN, (i + 1) * TOKEN)
            raw = data[np.minimum(starts[some, None] + place, len(data) - 1)]
            raw[place >= lengths[some, None]] = 0
            out[i, some] = raw.view(">u8").ravel()
    return out


def multikey_order(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the columns' records, and where it starts a new value.

    Each pass partitions by one token; only records tied so far are looked at again.
    """
    n = columns.shape[1]
    order = np.argsort(columns[0], kind="stable")
    fresh = runs_of(columns[0][order])
    for column in columns[1:]:
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if not len(tied):
            break
        group = np.cumsum(fresh)[tied]
        sub = order[tied]
        sub = sub[np.lexsort((column[sub], group))]
        order[tied] = sub
        split = np.zeros(n, bool)
        split[tied[1:]] = (np.diff(group) == 0) & (column[sub[1:]] != column[sub[:-1]])
        fresh |= split
    return order, fresh


def common_prefix(columns: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each record and the one before it in the order (0: the first)."""
    total = np.zeros(len(order), np.int64)
    going = np.ones(max(len(order) - 1, 0), bool)
    for column in columns:
        differ = column[order[1:]] ^ column[order[:-1]]
        equal = np.full(len(differ), TOKEN)
        for i in range(TOKEN):
            equal[(differ >> np.uint64(8 * i)) > 0] = TOKEN - 1 - i
        total[1:] += np.where(going, equal, 0)
        going &= equal == TOKEN
    return total


def best_with_any(columns: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Longest common prefix of each record with another one of its group."""
    order, _ = multikey_order(np.vstack((group[None].astype(np.uint64), columns)))
    with_last = np.where(runs_of(group[order]), 0, common_prefix(columns, order))
    best = np.empty(len(order), np.int64)
    best[order] = np.maximum(with_last, np.append(with_last[1:], 0))
    return best


def route_hashes(buckets: np.ndarray, dests: np.ndarray, window: int, kmer: int):
    """Task that sends anchor hashes; an anchor that several documents of a chunk share is settled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, named = batch.column(0).to_numpy(), tags(batch.column(1))
            for low, high, data, offsets in chunks(batch.column(2)):
                key, tag, a = keys[low:high], named[low:high], Anchors(data, offsets, window, kmer)
                if not len(a.first):
                    continue
                order = np.lexsort((key[a.doc], a.hash))
                fresh = runs_of(a.hash[order])
                group = np.cumsum(fresh) - 1
                several = np.bincount(group, runs_of(a.hash[order], key[a.doc][order]))[group] > 1
                shared = order[several]
                if len(shared):
                    yield settled_batch([(key[a.doc[shared]], tag[a.doc[shared]], a.number[shared], a.number[shared] + 1)], dests)
                # One record without an owner tells the others of a settled anchor.
                sent = np.sort(np.concatenate((order[~several], order[several & fresh])))
                nobody = np.zeros(len(a.first), bool)
                nobody[order[several]] = True
                target = ((a.hash >> np.uint64(32)) % np.uint64(len(buckets))).astype(np.int64)
                sent = sent[np.argsort(target[sent], kind="stable")]
                goes, blocks = [], []
                for cut in cuts_of(target[sent]):
                    r = sent[cut]
                    bits = a.hash[r] & np.uint64(2**HASH_BITS - 1)
                    records = {
                        "nobody": np.packbits(nobody[r]),
                        "low": small(a.number[r]),
                        "high_bits": (bits >> np.uint64(8)).astype(np.uint16),
                        "low_bits": bits.astype(np.uint8),
                    }
                    blocks.append(pack(owners(r, a.doc, key, tag) | records))
                    goes.append(target[r[0]])
                yield routed_batch(buckets[goes], blocks)

    return run


def shared_hashes(blocks: list[bytes]) -> Iterator[Found]:
    """Owned records whose hash another document has too."""
    parts = [unpack(b, HASH_FIELDS) for b in blocks]
    doc, keys, named = owned(parts)
    key = keys[doc]
    low = np.concatenate([p["low"] for p in parts]).astype(np.int64)
    hashes = np.concatenate([p["high_bits"].astype(np.int32) << 8 | p["low_bits"] for p in parts])
    own = ~np.concatenate([np.unpackbits(p["nobody"], count=len(p["low"])) for p in parts]).astype(bool)
    order = np.lexsort((key, hashes))
    group = np.cumsum(runs_of(hashes[order])) - 1
    holders = np.bincount(group, runs_of(hashes[order], key[order]) + 2.0 * ~own[order])[group]
    hit = order[(holders > 1) & own[order]]
    if len(hit):
        yield key[hit], named[doc[hit]], low[hit], low[hit] + 1


def route_suffixes(buckets: np.ndarray, splitters: np.ndarray, dests: np.ndarray, window: int, kmer: int):
    """Use of texts with shared anchors: their records go to the ranges of their leading tokens."""

    def use(keys: pa.Array, tag: np.ndarray, data: np.ndarray, offsets: np.ndarray, shared: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
        key, a = keys.to_numpy(), Anchors(data, offsets, window, kmer)
        begin = np.searchsorted(a.doc, np.arange(len(key)))
        chosen = np.unique(np.concatenate([begin[i] + s[:, 0] for i, s in enumerate(shared) if s is not None] or [np.zeros(0, np.int64)]))
        if not len(chosen):
            return
        first, size, doc = a.first[chosen], (a.end - a.first)[chosen], a.doc[chosen]
        inside, ids = a.inside[chosen], key[doc]
        content = a.content[chosen]
        order = np.lexsort((ids, content))
        copy = first_holders(order, runs_of(content[order]), ids, first, size, data)
        gone = order[copy]
        if len(gone):
            yield settled_batch([(ids[gone], tag[doc[gone]], inside[gone], inside[gone] + size[gone])], dests)
        anchor = a.at[chosen] - first
        target = np.searchsorted(splitters, tokens(data, a.at[chosen], np.full(len(chosen), kmer), 1)[0], "right")
        sent = np.sort(order[~copy])
        sent = sent[np.argsort(target[sent], kind="stable")]
        goes, blocks = [], []
        for cut in cuts_of(target[sent]):
            r = sent[cut]
            records = {"low": small(inside[r]), "anchor": small(anchor[r]), "sizes": small(size[r]), "text": ragged(data, first[r], size[r])}
            blocks.append(pack(owners(r, doc, key, tag) | records))
            goes.append(target[r[0]])
        yield routed_batch(buckets[goes], blocks)

    return use


def sort_suffixes(window: int, kmer: int):
    """Work of a range: suffix order, common prefixes, and the smallest document of equal strings."""
    right, left = -(-window // TOKEN), max(-(-(window - kmer) // TOKEN), 1)

    def work(blocks: list[bytes]) -> Iterator[Found]:
        parts = [unpack(b, TEXT_FIELDS) for b in blocks]
        doc, keys, named = owned(parts)
        low, anchor, sizes = (np.concatenate([p[f] for p in parts]).astype(np.int64) for f in TEXT_FIELDS[3:6])
        text = np.concatenate([p["text"] for p in parts])
        del parts
        at = np.cumsum(sizes) - sizes
        lead = tokens(text, at + anchor, sizes - anchor, 1)[0]
        order = np.argsort(lead, kind="stable")
        # The first token parts the suffixes; the rest of the sort runs inside of its values.
        for piece in pieces(lead[order], np.ones(len(order), np.int64), SORTED):
            r = order[piece]
            yield from sort_piece(keys[doc[r]], named[doc[r]], low[r], anchor[r], sizes[r], ragged(text, at[r], sizes[r]))

    def sort_piece(key, tag, low, anchor, sizes, text) -> Iterator[Found]:
        at = np.cumsum(sizes) - sizes
        suffix = tokens(text, at + anchor, sizes - anchor, right)
        # What precedes the anchor, nearest byte first.
        before = tokens(text[::-1], len(text) - at - anchor, anchor, left)
        order, fresh = multikey_order(np.vstack((suffix, before, (sizes << 32 | anchor)[None].astype(np.uint64))))
        start, run = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        copy = key[order] > np.minimum.reduceat(key[order], start)[run]
        gone = order[copy]
        if len(gone):
            yield key[gone], tag[gone], low[gone], low[gone] + sizes[gone]
        # Different records of one anchor may still share strings.
        head, lead = suffix[: kmer // TOKEN], order[start]
        group = np.cumsum(runs_of(*head[:, lead])) - 1
        reach = best_with_any(suffix[:, lead], group) + best_with_any(before[:, lead], group)
        rest = order[~copy & ((np.bincount(group)[group] > 1) & (reach >= window))[run]]
        family = np.cumsum(runs_of(*head[:, rest]))
        for piece in pieces(family, sizes[rest] - window + 1, EXPANDED):
            r = rest[piece]
            count = sizes[r] - window + 1
            shift = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            mine = np.repeat(r, count)
            order, fresh = multikey_order(tokens(text, at[mine] + shift, np.full(len(mine), window), right))
            smallest = np.minimum.reduceat(key[mine[order]], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
            hit = order[key[mine[order]] > smallest]
            if len(hit):
                yield key[mine[hit]], tag[mine[hit]], low[mine[hit]] + shift[hit], low[mine[hit]] + shift[hit] + window

    return work


def sampled_splitters(rows: DataFrame, ranges: int, window: int, kmer: int) -> np.ndarray:
    """``ranges`` - 1 leading tokens that cut the suffixes into ranges of about one size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                a = Anchors(data, offsets, window, kmer)
                count = np.bincount(a.doc, minlength=len(offsets) - 1)[a.doc]
                some = a.number * SAMPLE_SUFFIXES // count != (a.number - 1) * SAMPLE_SUFFIXES // count
                lead = tokens(data, a.at[some], np.full(int(some.sum()), kmer), 1)[0]
                yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64))], names=["lead"])

    n = rows.count()
    share = min(1.0, SAMPLE_DOCUMENTS / max(n, 1))
    lead = rows.select("text").sample(share, seed=7).mapInArrow(run, "lead long").toPandas()["lead"].to_numpy(np.int64).view(np.uint64)
    lead = np.sort(lead)
    return np.unique(lead[np.arange(1, ranges) * len(lead) // ranges]) if len(lead) else lead


def kept_bytes(key: pa.Array, tag: np.ndarray, data: np.ndarray, offsets: np.ndarray, spans: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
    """Rows with the bytes outside of their spans."""
    sizes = np.diff(offsets)
    keep, removed, runs = np.ones(len(data), bool), np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, pairs in enumerate(spans):
        if pairs is not None:
            gone = covered(pairs[:, 0], pairs[:, 1], int(sizes[i]))
            keep[offsets[i] : offsets[i + 1]] = ~gone
            removed[i] = gone.sum()
            runs[i] = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(gone[:1].any())
    columns = [key, pa.array(sizes), pa.array(removed), pa.array(runs), binary_array(data[keep], sizes - removed)]
    yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "n_removed", "n_spans", "kept"])


KEPT = "key long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, kmer: int = 16) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (remaining bytes) of every row.

    A byte goes if a ``window``-byte string over it also starts in a document with a smaller key.
    Null, empty and short texts lose nothing.  Rows of one key and text are one document and get the
    same result each; rows with a null key lose nothing and make others lose nothing.
    """
    rows, found, dests = _found(df, key, text, window, kmer, [])
    return with_spans(rows, found, dests, kept_bytes, KEPT).withColumnRenamed("key", key)


def _found(df: DataFrame, key: str, text: str, window: int, kmer: int, rest: list[str]) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Tagged rows, the blocks of their repeated spans, and the destinations of these."""
    if kmer % TOKEN or not TOKEN <= kmer <= window:
        raise ValueError("kmer must be a multiple of 8, at most the window")
    rows, dests = identified(tagged(df, key, text, rest)), even_buckets(df, 1)
    keyed = rows.select("key", "tag", "text").filter("key IS NOT NULL")
    buckets = even_buckets(df, buckets_each(keyed))
    hashes = keyed.mapInArrow(route_hashes(buckets, dests, window, kmer), ROUTED)
    shared = by_bucket(hashes, shared_hashes, dests)
    splitters = sampled_splitters(keyed, len(buckets), window, kmer)
    suffixes = with_spans(keyed, shared, dests, route_suffixes(buckets, splitters, dests, window, kmer), ROUTED)
    return rows, by_bucket(suffixes, sort_suffixes(window, kmer), dests), dests


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, kmer: int = 16) -> DataFrame:
    """The same rows and columns with the text that ``remove_repeats`` keeps.

    A character of which only some bytes stay goes whole.  A null text stays null.
    """

    def use(keys: pa.Array, tag: np.ndarray, data: np.ndarray, offsets: np.ndarray, spans: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
        for kept in kept_bytes(keys, tag, data, offsets, spans):
            texts = [x.decode("utf-8", "ignore") for x in kept.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["kept"])

    others = [c for c in df.columns if c != text]
    null = unused(df, "null_text")
    rows, found, dests = _found(df.withColumn(null, F.col(text).isNull()), key, text, window, kmer, [*others, null])
    whole = with_spans(rows, found, dests, use, "kept string")
    kept = F.when(F.col(f"rest_{len(others)}"), F.lit(None)).otherwise(F.col("kept"))
    return whole.select(*(kept.alias(text) if c == text else F.col(f"rest_{others.index(c)}").alias(c) for c in df.columns))
