"""Prefix trie of conversations, built by halving the depth as in the layout of van Emde Boas.

A set of sequences is cut at half its depth.  The cut prefixes get names; the prefixes are the upper
trie, and what follows one name is a lower trie of its own.  Both are cut again, all
tries of a level at once, until every piece is one turn deep and its name says which node it is.
So a conversation of ``n`` turns takes ``log n`` joins and is never gathered: a
turn is a row, and a piece of a level is a row of its conversation and place.

Totals go upward along the same cuts.  A node at depth ``m`` is the cut node of exactly one
level, that of the lowest bit of ``m``; the totals of the forest below it, down to the next cut of
a higher level, are added up once and grafted on the nodes of the upper trie above it.
Of a pair of a node and one below it, exactly one cut lies between.

Names are 128-bit digests of the name before and the digest of what was added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.scratch import written

#: Name of the trie's root.
ROOT = b""
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``place`` (from 0), ``symbol`` and ``size`` (bytes of the text) of every turn.

    Turns go by number, null first, then by role and text; a null role or text is an empty one. Rows
    without a conversation belong to none.  The order is that of the whole table, cut into
    ranges, so a conversation of any length is spread over tasks.
    """
    said, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = df.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), said.alias("role"), body.alias("text")).filter("conv IS NOT NULL")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    symbol = _digest(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sliced = written(ranged.select("conv", symbol.alias("symbol"), F.octet_length("text").cast("long").alias("size"), F.spark_partition_id().alias("slice"), place.alias("at")), "turn-slices")
    # One row for each conversation and slice it lies in, to number its turns across slices.
    parts = sliced.groupBy("conv", "slice").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    before = W.partitionBy("conv").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("conv", "slice", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return sliced.join(starts, ["conv", "slice"]).select("conv", (F.col("at") - F.col("low") + F.col("start")).alias("place"), "symbol", "size")


def rebuilt(turns_: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv``, ``depth``) that begin as the first of their group does, and their turns.

    Of conversation ``c`` the first ``h`` turns come from ``c - c % group``, ``h`` being the crc32 of ``c``
    modulo ``heads``, and its own turns after the first ``h`` follow.
    """
    h = F.crc32(F.col("conv").cast("string")) % heads
    sizes = turns_.groupBy("conv").agg(F.count("*").alias("n"))
    convs = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    given = sizes.select(F.col("conv").alias("base"), F.col("n").alias("given"))
    convs = convs.join(given, "base", "left").withColumn("first", F.least("h", F.coalesce("given", F.lit(0))))
    convs = written(convs.withColumn("depth", F.col("first") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt-conversations")
    heads_ = turns_.filter(F.col("place") < heads).withColumnRenamed("conv", "base")
    from_base = heads_.join(convs.select("base", "conv", "h"), "base").filter("place < h").select("conv", F.col("place").alias("place"), "symbol", "size")
    own = turns_.join(convs.select("conv", "h", "first"), "conv").filter("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("first")).alias("place"), "symbol", "size")
    return convs.select("conv", "depth"), from_base.unionByName(own)


def named(convs: DataFrame, rows: DataFrame, longest: int) -> DataFrame:
    """``conv``, ``depth`` (from 0) and ``name`` of every node on the way of every conversation.

    ``convs`` have ``conv`` and ``depth`` (its turns), ``rows`` ``conv``, ``place`` from 0 without gaps and ``symbol``;
    ``longest`` is the greatest number of turns.
    """
    levels = longest.bit_length()
    # Digests of whole pieces of 2 ** level turns: the upper halves of the pieces above.
    pieces = [rows.select("conv", "place", "symbol")]
    for level in range(1, levels):
        halves = pieces[-1].groupBy("conv", F.shiftright("place", 1).alias("place")).agg(*(F.max(F.when(F.col("place") % 2 == i, F.col("symbol"))).alias(half) for i, half in enumerate(("upper", "lower"))))
        whole = halves.filter("upper IS NOT NULL AND lower IS NOT NULL").select("conv", "place", _digest(F.col("upper"), F.col("lower")).alias("symbol"))
        pieces.append(written(whole, f"trie-pieces-{level}"))
    # Names of what stands before each piece, from the whole depth down; the last place stands behind the last turn.
    known = convs.select("conv", F.lit(0).cast("long").alias("place"), "depth", F.lit(ROOT).alias("name"))
    for level in reversed(range(levels)):
        uppers = pieces[level].filter(F.col("place") % 2 == 0).select("conv", F.shiftright("place", 1).alias("place"), F.col("symbol").alias("upper"))
        cut = known.join(uppers, ["conv", "place"], "left")
        upper = F.struct((F.col("place") * 2).alias("place"), F.col("name").alias("name"))
        lower = F.struct((F.col("place") * 2 + 1).alias("place"), _digest(F.col("name"), F.col("upper")).alias("name"))
        split = cut.select("conv", "depth", F.explode(F.array(upper, lower)).alias("p")).select("conv", "p.place", "depth", "p.name")
        known = written(split.filter(F.col("place") * (1 << level) <= F.col("depth")), f"trie-names-{level}")
    return known.select("conv", F.col("place").alias("depth"), "name")


def _lowest_bit(depth: str) -> Column:
    return F.col(depth).bitwiseAND(-F.col(depth))


def grafted(nodes: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """``name`` and, for each of ``values``, the sum over all nodes strictly below, where there are any.

    ``nodes`` have ``name``, ``conv`` (some conversation through the node), ``depth`` and the values; ``paths`` give the
    ``name`` of the node of every ``conv`` and ``depth``.
    """
    sums = [F.sum(v).alias(v) for v in values]
    # A node lies in the forest below each depth that clears low bits of its place.
    cuts = F.expr("transform(filter(sequence(0, 40), k -> (shiftright(depth - 1, k) & 1) = 1), k -> shiftleft(shiftright(depth - 1, k), k))")
    forests = nodes.filter("depth > 1").select("conv", F.explode(cuts).alias("depth"), *values).groupBy("conv", "depth").agg(*sums)
    forests = forests.join(paths.select("conv", "depth", "name"), ["conv", "depth"]).groupBy("name").agg(*sums)
    # The upper trie above a cut node: as many depths as its lowest bit says, itself included.
    cut = forests.join(nodes.select("name", "conv", "depth"), "name")
    above = cut.select("conv", F.explode(F.sequence(F.col("depth") - _lowest_bit("depth") + 1, F.col("depth"))).alias("depth"), *values).groupBy("conv", "depth").agg(*sums)
    return above.join(paths.select("conv", "depth", "name"), ["conv", "depth"]).groupBy("name").agg(*sums)


def ends(members: DataFrame) -> DataFrame:
    """``name`` and ``ends_sha256``: SHA-256 of its conversations, ascending and joined by commas.

    Runs of sorted conversations are joined where they lie, so a node with very many of them sends a few
    strings to the task that digests them one after the other.
    """

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            low, out = 0, []
            for at in range(1, len(names) + 1):
                if at == len(names) or names[at] != names[low]:
                    out.append((names[low], convs[low], ",".join(map(str, convs[low:at]))))
                    low = at
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["name", "first", "run"])

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, whole, out = None, None, []
        for batch in batches:
            for found, run in zip(batch.column(0).to_pylist(), batch.column(2)):
                if found != name:
                    if name is not None:
                        out.append((name, whole.hexdigest()))
                    name, whole = found, hashlib.sha256()
                else:
                    whole.update(b",")
                whole.update(run.as_py().encode())
            if out:
                yield done(out)
                out = []
        if name is not None:
            yield done([(name, whole.hexdigest())])

    def done(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["name", "ends_sha256"])

    ordered = members.select("name", "conv").repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    parts = ordered.mapInArrow(runs, "name binary, first long, run string")
    return parts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digests, "name binary, ends_sha256 string")


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """All nodes of the trie of the conversations: one row for each different sequence of first turns.

    ``conv_id`` is the smallest conversation that begins so, ``n_leaves`` and ``saved_tokens`` are
    totals of the subtree.  The root is there if there is any conversation, also one without turns.
    """
    longest = convs.agg(F.max("depth")).first()[0] or 0
    rows = written(rows, "trie-turns")
    paths = written(named(convs, rows, longest), "trie-paths")
    seen = paths.groupBy("name").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.first("depth").alias("depth"))
    sizes = rows.select("conv", (F.col("place") + 1).alias("depth"), "size")
    before = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    seen = written(seen.join(sizes, ["conv", "depth"], "left").join(before, ["conv", "depth"], "left"), "trie-seen")
    children = seen.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = seen.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.coalesce("size", F.lit(0)))
    nodes = written(nodes, "trie-nodes")
    values = ["n_leaves", "saved_tokens"]
    turns_ = nodes.filter("depth > 0")
    whole = turns_.groupBy().agg(*(F.sum(v).alias(v) for v in values)).filter("n_leaves IS NOT NULL").select(F.lit(ROOT).alias("name"), *values)
    below = grafted(turns_, paths, values).unionByName(whole)
    last = paths.join(convs, ["conv", "depth"]).select("name", "conv")
    parents = nodes.filter("n_children > 0").select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(below.select("name", *(F.col(v).alias(f"more_{v}") for v in values)), "name", "left").join(ends(last), "name", "left").join(parents, "parent", "left")
    totals = [(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", *totals, F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations as they are."""
    rows = written(turns(df, conv, turn, role, text), "turns")
    return trie(rows.groupBy("conv").agg(F.count("*").alias("depth")), rows)


def rebuilt_trie(df: DataFrame) -> DataFrame:
    """The trie of the conversations after ``rebuilt``."""
    return trie(*rebuilt(written(turns(df), "turns")))
