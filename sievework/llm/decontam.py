"""Benchmark passages in documents, with DataFrame functions only.

1. Word shingles of documents that also occur in a benchmark item say where the item may begin.
   A window with enough similarity shares most shingles, so pairs with fewer distinct shared shingles
   than the similarity needs are left out, and what is left has a handful of possible beginnings.
2. At each of these a window with as many words as the item (a whole document with fewer) gets a SimHash fingerprint.
3. Fingerprints meet by blocks of bits that cannot differ.  A window of the similarity differs from the item in
   so many shingles at most, and each of them moves the margin by which a bit is set by one; so a bit
   whose margin is wider is equal.  These bits of an item are its block, the others its Hamming radius:
   no window of the similarity lies outside of it, repetitive texts included.
   Each different fingerprint is looked up once, however many documents hold it.
4. The similarity of the candidates is computed exactly: sum of minima over sum of maxima of the
   shingles' weights (how often each occurs) in window and item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.spans import tag_of
from sievework.scratch import written

SHINGLE = 5
SIMILARITY = 0.8
#: Benchmark shingles up to which they are sent to every task; beyond, Spark joins by shuffle.
SENT_SHINGLES = 1_000_000

def word_hashes(text: Column) -> Column:
    """Hashes of the words of a lower-cased text; null and empty texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[ \t-\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, by start."""
    starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(0), F.size(hashes) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size))))


def bit_margins(hashes: Column) -> list[Column]:
    """For each of the 64 bits: in how many hashes it is set, less in how many it is not.

    Two counters share a long; an array is shorter than a counter is wide.
    """
    wide, each = 31, 2
    zero = F.lit(0).cast("long")

    def spread(h: Column, lane: int) -> Column:
        return reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(F.shiftrightunsigned(h, each * lane + k).bitwiseAND(F.lit(1).cast("long")), wide * k) for k in range(each)))

    def counted(lane: int) -> Column:
        return F.aggregate(hashes, zero, lambda a, h: a + spread(h, lane))

    sums = [counted(lane) for lane in range(64 // each)]
    count = lambda bit: F.shiftrightunsigned(sums[bit // each], wide * (bit % each)).bitwiseAND(F.lit(2**wide - 1).cast("long"))
    return [2 * count(bit) - F.size(hashes) for bit in range(64)]


def _bits(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), (F.when(flag, F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")) for bit, flag in enumerate(flags)))


def fingerprint(hashes: Column) -> Column:
    """SimHash of an array of hashes: a bit is 1 if set in more than half of them."""
    return _bits([margin > 0 for margin in bit_margins(hashes)])


def certain_bits(hashes: Column, threshold: float) -> Column:
    """Bits that the fingerprint of every window of the similarity, not longer than this, has in common with it.

    Windows of m and n shingles with c common ones differ in m + n - 2 c, and c (1 + t) >= t (m + n).
    """
    most = F.floor(2 * F.size(hashes) * (1 - threshold) / (1 + threshold) + 1e-9)
    return _bits([(margin > most) | (margin <= -most) for margin in bit_margins(hashes)])


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of hashes, weights being counts."""
    times = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    weighted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    # Without repeats on one side every common hash weighs one.
    single = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    common = F.when(single, F.size(F.array_intersect(a, b))).otherwise(weighted)
    return F.when(a == b, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def by_width(size: Column, hashes: Column) -> Column:
    """Shingle hashes by a shingle size that differs from row to row."""
    return reduce(lambda other, w: F.when(size == w, shingle_hashes(hashes, w)).otherwise(other), range(1, SHINGLE + 1), F.array().cast("array<bigint>"))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", threshold: float = SIMILARITY) -> DataFrame:
    """``key``, ``item``, ``similarity`` of the best window and its first word ``start`` (of equally good ones
    the first that lines up with a shingle of the item).

    One row for every document and item of which a window with the item's number of words has
    ``threshold`` similarity or more.  Shingles have five words; an item with fewer words is one shingle.
    Items without words or without a number match nothing, null and empty texts hold nothing.  The window of a
    document with fewer words than the item is the whole document.  Rows of one key and text are one document; rows with a null key are left out.
    """
    best = F.max(F.struct("similarity", (-F.col("start")).alias("minus"))).alias("best")
    found = document_leaks(docs, benchmark, key, text, item, threshold).groupBy("key", "item").agg(best)
    return found.select(F.col("key").alias(key), F.col("item").alias(item), (-F.col("best.minus")).alias("start"), F.col("best.similarity").alias("similarity"))


def document_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", threshold: float = SIMILARITY) -> DataFrame:
    """The same by document, ``key`` and ``tag`` (digest of the text): ``key``, ``tag``, ``item``, ``start``, ``similarity``."""
    hashed = benchmark.select(F.col(item).alias("item"), word_hashes(F.col(text)).alias("h")).filter(F.col("item").isNotNull() & (F.size("h") > 0))
    items = hashed.withColumn("width", F.least(F.size("h"), F.lit(SHINGLE))).withColumn("s", by_width(F.col("width"), F.col("h")))
    items = written(items.select("item", "width", "s", F.size("s").alias("n"), fingerprint(F.col("s")).alias("item_fp"), certain_bits(F.col("s"), threshold).alias("block")), "items")
    needles = items.select("item", "width", "n", F.posexplode("s").alias("k", "shingle"))
    few = needles.count() <= SENT_SHINGLES
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())

    rows = docs.select(F.col(key).cast("long").alias("key"), tag_of(F.col(text).cast("string")).alias("tag"), F.col(text).alias("text")).filter("key IS NOT NULL")
    hits = []
    for width in widths:
        mine = needles.filter(F.col("width") == width)
        # The hashes are a column of their own: inside the shingle function they would be made anew for each shingle.
        found = rows.withColumn("h", word_hashes(F.col("text"))).select("key", "tag", F.size("h").alias("words"), F.posexplode(shingle_hashes(F.col("h"), width)).alias("at", "shingle"))
        hits.append(found.join(F.broadcast(mine) if few else mine, "shingle").select("key", "tag", "words", "item", "width", "n", "k", (F.col("at") - F.col("k")).alias("start")))
    if not hits:
        none = F.lit(None)
        return rows.filter(F.lit(False)).select("key", "tag", none.cast("long").alias("item"), none.cast("int").alias("start"), none.cast("double").alias("similarity"))
    shared = reduce(DataFrame.unionByName, hits).groupBy("key", "tag", "words", "item", "width", "n").agg(F.size(F.collect_set("k")).alias("common"), F.collect_set("start").alias("starts"))
    # Similarity t of m and n shingles needs t(m + n) / (1 + t) common ones; m is below n only where the whole document is.
    m = F.least(F.col("n"), F.col("words") - F.col("width") + 1)
    enough = shared.filter((m >= threshold * F.col("n") - 1e-9) & (F.col("common") * (1 + threshold) >= threshold * (m + F.col("n")) - 1e-9))
    # Items of a document: at most those of the benchmark.
    pairs = written(enough.groupBy("key", "tag", "width").agg(F.collect_list(F.struct("item", "n", "starts")).alias("items")), "shared-shingles")

    # Words added or lost shift the parts of a passage; the best window lies between them.
    slack = F.floor(F.col("n") * (1 - threshold) / (1 + threshold) + 1e-9).cast("int")
    last = F.greatest(F.lit(0), F.size("s") - F.col("n"))
    near = F.flatten(F.transform("starts", lambda x: F.sequence(x, x + slack)))
    begins = F.array_distinct(F.transform(near, lambda x: F.greatest(F.lit(0), F.least(x, last))))
    # Written, so that no filter or generator pulls the making of the hashes into its own expressions.
    held = rows.join(pairs, ["key", "tag"]).withColumn("h", word_hashes(F.col("text"))).withColumn("s", by_width(F.col("width"), F.col("h")))
    held = written(held.select("key", "tag", "width", "items", "s"), "candidate-documents")
    held = held.select("key", "tag", "width", F.inline("items"), "s")
    shape = ["item", "width", "n"]
    windows = held.select("key", "tag", *shape, "s", F.explode(begins).alias("start")).select("key", "tag", *shape, "start", F.slice("s", F.col("start") + 1, F.col("n")).alias("window"))
    windows = written(windows.withColumn("fp", fingerprint(F.col("window"))), "windows")

    probes = windows.select(*shape, "fp").distinct()
    equal = F.col("fp").bitwiseXOR(F.col("item_fp")).bitwiseAND(F.col("block")) == 0
    close = probes.join(items.select(*shape, "item_fp", "block"), shape).filter(equal).select(*shape, "fp").distinct()
    alike = windows.join(close, [*shape, "fp"]).join(items.select(*shape, "s"), shape).withColumn("similarity", similarity(F.col("window"), F.col("s")))
    best = alike.filter(F.col("similarity") >= threshold).groupBy("key", "tag", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("minus"))).alias("best"))
    return best.select("key", "tag", "item", (-F.col("best.minus")).alias("start"), F.col("best.similarity").alias("similarity"))
