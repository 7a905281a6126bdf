"""What the two span-removing operators share: routing of packed records, and spans brought to texts.

Records travel as compressed blocks of many rows.  Texts travel once, packed as well, to the task
that also gets the spans found in them.  Bucket numbers are chosen so that Spark's hash
partitioning deals them out evenly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc  # noqa: F401  (pa.ipc)
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import CHUNK_BYTES, chunks, mixed, ragged, text_buffer
from sievework.scratch import written

#: Rows between tasks: a packed block of records for a bucket, or finished spans on their way to ``dest``.
ROUTED = "bucket int, dest int, block binary"
FOUND = "dest int, block binary"
#: Spans of documents: each document once, its number of spans, then all spans.
SPANS = ["key", "tag", "counts", "low", "size"]
TEXTS = ["key", "tag", "nulls", "sizes", "text", "rest"]
#: Buckets for each shuffle partition at least, and bytes of text for which there is one at least; no effect on results.
BUCKETS_EACH = 2
BUCKET_BYTES = 16 << 20
#: Documents up to which a list of them is sent to every task (24 bytes each).
SENT_DOCUMENTS = 200_000
#: Finished spans a task holds, and bytes of text it packs or works on at once; no effect on results.
HELD_SPANS = 200_000
PACKED_BYTES = 4 << 20
WORKED_BYTES = 3 << 19
LEVEL = 2

Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


#: Tags of texts, 16 bytes each, as numpy holds them.
TAG = np.dtype("S16")


def tag_of(text: Column) -> Column:
    """128-bit digest of a text; of a null one, zeros."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(bytes(TAG.itemsize)))


def tags(column: pa.Array) -> np.ndarray:
    """A column of tags as an array."""
    return text_buffer(column)[0].view(TAG)


def tagged(df: DataFrame, key: str, text: str, rest: list[str] | None = None) -> DataFrame:
    """``key``, ``tag`` (128-bit digest of the text), ``text`` and the columns ``rest`` as ``rest_0`` and so on.

    Rows of one key and tag are one document.
    """
    whole = F.col(text).cast("string")
    more = [F.col(f"`{c}`").alias(f"rest_{i}") for i, c in enumerate(rest or [])]
    return df.select(F.col(key).cast("long").alias("key"), tag_of(whole).alias("tag"), whole.alias("text"), *more)


def identified(rows: DataFrame) -> DataFrame:
    """Tagged rows whose tag is zeros where the key alone names the document.

    Tags do not compress, and a record carries its document's; so only rows of keys with several texts keep theirs, and
    those without a key.  Beyond ``SENT_DOCUMENTS`` such keys all rows do.
    """
    ends = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("tag").alias("low"), F.max("tag").alias("high"))
    several = written(ends.filter("low <> high").select("key", F.lit(True).alias("several_texts")), "keys-of-several-texts")
    n = several.count()
    if n > SENT_DOCUMENTS:
        return rows
    kept = F.col("key").isNull()
    marked = rows
    if n:
        marked, kept = rows.join(F.broadcast(several), "key", "left"), kept | F.coalesce("several_texts", F.lit(False))
    tag = F.when(kept, F.col("tag")).otherwise(F.lit(bytes(TAG.itemsize))).alias("tag")
    return marked.select(*(tag if c == "tag" else c for c in rows.columns))


def without(df: DataFrame, documents: DataFrame, key: str = "doc_id", text: str = "text", how: str = "left_anti") -> DataFrame:
    """Rows of ``df`` that are none of the ``documents`` (``key``, ``tag``; a written table).

    Up to ``SENT_DOCUMENTS`` they go to every task, so that no text is shuffled; beyond, Spark joins by shuffle.
    """
    names = {c: unused(df, f"other_{c}") for c in ("key", "tag")}
    other = documents.select(*(F.col(c).alias(n) for c, n in names.items()))
    same = (F.col(key).cast("long") == F.col(names["key"])) & (tag_of(F.col(text).cast("string")) == F.col(names["tag"]))
    return df.join(F.broadcast(other) if documents.count() <= SENT_DOCUMENTS else other, same, how)


def one_row_each(df: DataFrame, dropped: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` but those of the documents ``dropped`` (``key``, ``tag``), each document once."""
    kept = without(df, dropped, key, text)
    repeated = tagged(df, key, text).filter("key IS NOT NULL").groupBy("key", "tag").count().filter("count > 1")
    repeated = written(repeated.select("key", "tag"), "repeated-documents")
    if repeated.isEmpty():
        return kept
    own = unused(df, "own_tag")
    once = without(kept, repeated, key, text, "left_semi").withColumn(own, tag_of(F.col(text).cast("string"))).dropDuplicates([key, own]).drop(own)
    return without(kept, repeated, key, text).unionByName(once)


def unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def even_buckets(df: DataFrame, each: int) -> np.ndarray:
    """Bucket numbers, ``each`` for every shuffle partition, that hash partitioning sends there."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(partitions))
    tried = spark.range(partitions * (16 + 4 * each)).select(F.col("id").cast("int").alias("id"), place.alias("place")).toPandas()
    tried["rank"] = tried.groupby("place").cumcount()
    chosen = tried[tried["rank"] < each].sort_values(["rank", "place"])["id"].to_numpy(np.int32)
    return chosen if len(chosen) == partitions * each else np.arange(partitions * each, dtype=np.int32)


def buckets_each(rows: DataFrame) -> int:
    """Buckets for each shuffle partition, so that a bucket's share of the texts is bounded however many there are."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(BUCKETS_EACH, -(-size // (partitions * BUCKET_BYTES)))


def pack(columns: dict[str, np.ndarray]) -> bytes:
    """Arrays of any kinds and lengths as one compressed block."""
    head = np.array([[ord(a.dtype.kind), a.dtype.itemsize, len(a)] for a in columns.values()], np.int64)
    body = head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in columns.values())
    return zstandard.ZstdCompressor(level=LEVEL).compress(body)


def unpack(block: bytes, names: list[str]) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    head = np.frombuffer(raw, np.int64, 3 * len(names)).reshape(-1, 3)
    out, at = {}, head.nbytes
    for name, (kind, size, n) in zip(names, head.tolist()):
        out[name] = np.frombuffer(raw, np.dtype(f"{chr(kind)}{size}"), n, at)
        at += n * size
    return out


def small(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned kind."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def runs_of(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted table starts a new combination of values."""
    fresh = np.ones(len(columns[0]), bool)
    if len(fresh):
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return fresh


def cuts_of(sorted_: np.ndarray) -> Iterator[slice]:
    """Runs of equal values."""
    edges = np.append(np.flatnonzero(runs_of(sorted_)), len(sorted_)).tolist()
    return (slice(a, b) for a, b in zip(edges[:-1], edges[1:]))


def pieces(group: np.ndarray, weight: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of whole groups (sorted) of about ``limit`` in weight."""
    low, size = 0, 0
    edges = np.append(np.flatnonzero(runs_of(group)), len(group))
    sums = np.concatenate(([0], np.cumsum(weight)))[edges]
    while low < len(edges) - 1:
        high = max(int(np.searchsorted(sums, sums[low] + limit, "right")) - 1, low + 1)
        yield slice(int(edges[low]), int(edges[high]))
        low = high


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the ranges at ``a`` and ``b`` hold the same bytes."""
    same = np.ones(len(a), bool)
    for low in range(0, len(a), 1 << 14):
        n = lengths[low : low + (1 << 14)]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        differ = data[at + np.repeat(a[low : low + len(n)], n)] != data[at + np.repeat(b[low : low + len(n)], n)]
        same[low + np.repeat(np.arange(len(n)), n)[differ]] = False
    return same


def dest_of(key: np.ndarray, tag: np.ndarray, dests: int) -> np.ndarray:
    """Destination of a document: texts of one key spread as well."""
    half = np.ascontiguousarray(tag).view(np.uint64)[::2]
    return (mixed(mixed(key.astype(np.int64).view(np.uint64)) ^ half) % np.uint64(dests)).astype(np.int64)


def blocks_of_spans(spans: list[Found], dests: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Spans (key, tag, low, high) as one block for each destination."""
    key, tag, low, high = (np.concatenate(x) for x in zip(*spans))
    dest = dest_of(key, tag, len(dests))
    order = np.lexsort((low, tag, key, dest))
    key, tag, low, size, dest = key[order], tag[order], low[order], (high - low)[order], dest[order]
    goes, blocks = [], []
    for r in cuts_of(dest):
        first = np.flatnonzero(runs_of(key[r], tag[r]))
        counts = np.diff(np.append(first, r.stop - r.start))
        blocks.append(pack({"key": key[r][first], "tag": tag[r][first], "counts": small(counts), "low": small(low[r]), "size": small(size[r])}))
        goes.append(dest[r.start])
    return dests[goes], blocks


def settled_batch(spans: list[Found], dests: np.ndarray) -> pa.RecordBatch:
    """Spans that need no bucket, in the form of routed rows."""
    goes, blocks = blocks_of_spans(spans, dests)
    return pa.RecordBatch.from_arrays([pa.array(goes), pa.array(goes), pa.array(blocks, pa.binary())], names=["bucket", "dest", "block"])


def routed_batch(buckets: np.ndarray, blocks: list[bytes]) -> pa.RecordBatch:
    """Blocks of records for buckets."""
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.nulls(len(blocks), pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "dest", "block"])


def owned(parts: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the records of several blocks: each one's document, and the documents' keys and tags."""
    first = np.cumsum([0, *(len(p["key"]) for p in parts)])
    doc = np.concatenate([p["doc"].astype(np.int32) + np.int32(f) for p, f in zip(parts, first)])
    return doc, np.concatenate([p["key"] for p in parts]), np.concatenate([p["tag"] for p in parts])


def owners(r: np.ndarray, owner: np.ndarray, key: np.ndarray, tag: np.ndarray) -> dict[str, np.ndarray]:
    """Documents of records ``r``, each once, and the place of each record's document among them."""
    some, local = np.unique(owner[r], return_inverse=True)
    return {"key": key[some], "tag": tag[some], "doc": small(local)}


def by_bucket(routed: DataFrame, work: Callable[[list[bytes]], Iterator[Found]], dests: np.ndarray) -> DataFrame:
    """Blocks of spans: those settled before, and those ``work`` finds in the blocks of a bucket.

    Buckets stream through a task one after the other, so its memory is that of one bucket.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket, spans, size = [], None, [], 0

        def sent() -> pa.RecordBatch:
            goes, blocks = blocks_of_spans(spans, dests)
            return pa.RecordBatch.from_arrays([pa.array(goes), pa.array(blocks, pa.binary())], names=["dest", "block"])

        for batch in with_end(batches):
            rows = [(None, None)]
            if batch is not None:
                open_ = batch.column(1).is_null()
                done = batch.filter(pc.invert(open_))
                if len(done):
                    yield pa.RecordBatch.from_arrays(done.columns[1:], names=["dest", "block"])
                todo = batch.filter(open_)
                rows = zip(todo.column(0).to_pylist(), todo.column(2))
            for b, block in rows:
                if b != bucket and held:
                    for found in work(held):
                        spans.append(found)
                        size += len(found[0])
                        if size > HELD_SPANS:
                            yield sent()
                            spans, size = [], 0
                    held = []
                bucket = b
                if block is not None:
                    held.append(block.as_py())
        if size:
            yield sent()

    return routed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FOUND)


def with_end(batches: Iterable) -> Iterator:
    yield from batches
    yield None


def with_spans(rows: DataFrame, found: DataFrame, dests: np.ndarray, use: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``use`` on chunks of tagged rows with the spans found in them.

    ``use`` gets keys (an Arrow column), tags, bytes, offsets and, for each row, its spans as pairs (or None).
    Further columns of the rows travel along and follow those of ``use``, which then gives a row for each row.
    Spans come before the texts of their destination; texts stream.
    """
    more = rows.schema[3:]

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).fill_null(0).to_numpy()
            nulls, named = batch.column(0).is_null().to_numpy(zero_copy_only=False), tags(batch.column(1))
            for low, high, data, offsets in chunks(batch.column(2), PACKED_BYTES):
                key, tag, sizes = keys[low:high], named[low:high], np.diff(offsets)
                # Rows without a key have no spans; their texts spread them.
                dest = dest_of(key, tag, len(dests))
                order = np.argsort(dest, kind="stable")
                goes, blocks = [], []
                for r in cuts_of(dest[order]):
                    i = order[r]
                    text = ragged(data, offsets[i], sizes[i])
                    blocks.append(pack({"key": key[i], "tag": tag[i], "nulls": nulls[low:high][i], "sizes": small(sizes[i]), "text": text, "rest": _serialised(batch, low + i)}))
                    goes.append(dest[i[0]])
                yield pa.RecordBatch.from_arrays([pa.array(dests[goes]), pa.array(np.ones(len(goes), np.int32)), pa.array(blocks, pa.binary())], names=["dest", "kind", "block"])

    def worked(blocks: list[dict[str, np.ndarray]], spans: dict) -> Iterator[pa.RecordBatch]:
        keys, tag, nulls, sizes, text = (np.concatenate([t[f] for t in blocks]) for f in TEXTS[:5])
        rest = [pa.ipc.open_stream(pa.py_buffer(t["rest"])).read_next_batch() for t in blocks if len(t["rest"])]
        rest = pa.Table.from_batches(rest) if rest else None
        key = pa.array(keys, mask=nulls)
        mine = [None if null else spans.get(k) for k, null in zip(zip(keys.tolist(), tag.tolist()), nulls.tolist())]
        offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        low, n = 0, len(mine)
        while low < n:
            high = min(max(int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1, low + 1), n)
            for out in use(key.slice(low, high - low), tag[low:high], text[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], mine[low:high]):
                if rest is None:
                    yield out
                else:
                    more_ = rest.slice(low, high - low).combine_chunks()
                    yield pa.RecordBatch.from_arrays([*out.columns, *(c.chunk(0) for c in more_.columns)], names=[*out.schema.names, *more_.column_names])
            low = high

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dest, held, spans, waiting, size = None, [], {}, [], 0
        for batch in with_end(batches):
            rows = [(None, None, None)] if batch is None else zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            for d, kind, block in rows:
                if waiting and (d != dest or size >= WORKED_BYTES):
                    yield from worked(waiting, spans)
                    waiting, size = [], 0
                if d != dest:
                    dest, held, spans = d, [], None
                if kind == 0:
                    held.append(unpack(block.as_py(), SPANS))
                elif kind == 1:
                    if spans is None:
                        spans, held = _by_document(held), []
                    waiting.append(unpack(block.as_py(), TEXTS))
                    size += len(waiting[-1]["text"])

    texts = rows.mapInArrow(packed, "dest int, kind int, block binary")
    both = found.select("dest", F.lit(0).alias("kind"), "block").unionByName(texts)
    return both.repartition("dest").sortWithinPartitions("dest", "kind").mapInArrow(run, ", ".join([schema, *(f"{f.name} {f.dataType.simpleString()}" for f in more)]))


def _serialised(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    """The columns beyond key, tag and text of some rows, as an Arrow stream."""
    if batch.num_columns <= 3:
        return np.zeros(0, np.uint8)
    rest = batch.select(range(3, batch.num_columns)).take(pa.array(rows))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rest.schema) as writer:
        writer.write_batch(rest)
    return np.frombuffer(sink.getvalue(), np.uint8)


def _by_document(blocks: list[dict[str, np.ndarray]]) -> dict[tuple[int, bytes], np.ndarray]:
    """Spans of each document as sorted pairs."""
    if not blocks:
        return {}
    key, tag = (np.concatenate([np.repeat(b[f], b["counts"]) for b in blocks]) for f in ("key", "tag"))
    low, size = (np.concatenate([b[f] for b in blocks]).astype(np.int64) for f in ("low", "size"))
    order = np.lexsort((low, tag, key))
    key, tag, pairs = key[order], tag[order], np.stack((low, low + size), axis=1)[order]
    edges = np.append(np.flatnonzero(runs_of(key, tag)), len(key)).tolist()
    return {(int(key[a]), bytes(tag[a])): pairs[a:b] for a, b in zip(edges[:-1], edges[1:])}
