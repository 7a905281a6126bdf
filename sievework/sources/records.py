"""Records of delimited text whose quoted fields may hold line ends, read by many tasks.

A file is read in blocks, as Spark cuts it.  Whether a line end inside a block ends a record depends
on whether the block begins inside of quotes, which its own text cannot tell.  So each block is
first judged for both cases: whether it ends inside of quotes, and where its last record begins.
Running over the blocks of a file these two-case answers compose, which gives the true state at
the start of each block.  With that, blocks are read in parallel: a record inside a block is complete there;
the pieces of a record that crosses blocks, at most two a block, meet by its position.

A quote opens a quoted field only as the first character of the field; a doubled quote inside stands for
one.  The position of a record (file, block, line of the block) is its order of arrival.  It depends on the
file and the block size alone, so a task that runs again gives the same.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.scratch import written

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Blocks up to which their states are sent to every task (tens of bytes each); beyond, Spark joins by shuffle.
SENT_BLOCKS = 200_000
POSITION = ("file", "block", "line")


class Quoting:
    """State after a line for each state before it: False outside, True inside of quotes."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        field = rf'(?:"(?:[^"]|"")*+"[^{s}]*+|[^"{s}][^{s}]*+)?'
        #: Whole fields, then a quoted one that is not closed.
        self.opens = re.compile(rf'(?:{field}{s})*+"(?:[^"]|"")*+\Z', re.DOTALL)
        #: The rest of a quoted field and of what follows its closing quote.
        self.closes = re.compile(rf'(?:[^"]|"")*+"[^{s}]*+(?P<more>{s})?', re.DOTALL)

    def after(self, line: str) -> tuple[bool, bool]:
        rest = self.closes.match(line)
        inside = rest is None or bool(rest["more"]) and self.opens.match(line, rest.end()) is not None
        return self.opens.match(line) is not None, inside


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``block`` and ``text`` of every line; lines of a block in their order."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch, bool]]:
    """Parts of batches that lie in one block, and whether a part is the first one of its block."""
    before = None
    for batch in batches:
        if not len(batch):
            continue
        codes = batch.column(0).dictionary_encode().indices.to_numpy()
        blocks = batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            here = batch.column(0)[low].as_py(), int(blocks[low])
            yield *here, batch.slice(low, high - low), here != before
            before = here


def _quoted(text: pa.Array) -> np.ndarray:
    """Places of the lines that hold a quote; the others change no state."""
    return np.flatnonzero(pc.match_substring(text, '"').to_numpy(zero_copy_only=False))


def block_states(lines: DataFrame, sep: str) -> DataFrame:
    """For each block and both states at its start: the state at its end (``end0``, ``end1``), and the
    line at which its last record begins (``last0``, ``last1``, null: none does)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting, found, open_ = Quoting(sep), [], None
        for file, block, batch, fresh in _runs(batches):
            if fresh:
                if open_:
                    found.append(open_)
                open_ = [file, block, [False, True], [None, None], 0]
            _, _, states, last, line = open_
            text, at = batch.column(2), 0
            for i in [*_quoted(text).tolist(), len(text)]:
                # Lines without a quote up to here, then the line with one.
                for case in (0, 1):
                    if not states[case] and line + at < line + min(i + 1, len(text)):
                        last[case] = line + min(i, len(text) - 1)
                if i < len(text):
                    after = quoting.after(text[i].as_py())
                    open_[2] = states = [after[s] for s in states]
                    at = i + 1
            open_[4] += len(text)
        if open_:
            found.append(open_)
        if found:
            columns = list(zip(*((f, b, *s, *last) for f, b, s, last, _ in found)))
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "end0", "end1", "last0", "last1"])

    return lines.mapInArrow(run, "file string, block long, end0 boolean, end1 boolean, last0 long, last1 long")


def block_starts(states: DataFrame) -> DataFrame:
    """``file``, ``block``, ``inside`` (the state at its start), the record open there (``of_block``, ``of_line``) and ``ends_inside``.

    A block with one end for both cases is certain; the blocks after it either keep the state or turn it.
    """
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    certain = F.when(F.col("end0") == F.col("end1"), F.col("end0"))
    turns = F.coalesce(F.sum((F.col("end0") & ~F.col("end1")).cast("int")).over(earlier), F.lit(0))
    known = states.withColumn("turns", turns).withColumn("certain", F.when(certain.isNotNull(), F.struct(certain.alias("state"), F.col("turns").alias("at"))))
    base = F.coalesce(F.last("certain", ignorenulls=True).over(earlier), F.struct(F.lit(False).alias("state"), F.lit(0).cast("long").alias("at")))
    known = known.withColumn("base", base).withColumn("inside", (F.col("turns") - F.col("base.at") + F.col("base.state").cast("int")) % 2 == 1)
    last = F.when(F.col("inside"), F.col("last1")).otherwise(F.col("last0"))
    begun = F.when(last.isNotNull(), F.struct(F.col("block").alias("block"), last.alias("line")))
    known = known.withColumn("begun", begun).withColumn("open", F.last("begun", ignorenulls=True).over(earlier))
    ends = F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0"))
    return known.select("file", "block", "inside", F.col("open.block").alias("of_block"), F.col("open.line").alias("of_line"), ends.alias("ends_inside"))


def _pieces(lines: DataFrame, starts: DataFrame, sep: str, wholes: bool) -> DataFrame:
    """Records of each block that are whole, or else pieces: position of the record, number of the ``part``, text."""
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    few = starts.count() <= SENT_BLOCKS
    known = numbered.join(F.broadcast(starts) if few else starts, ["file", "block"]).select("file", "block", "text", "inside", "of_block", "of_line", "at")
    if not few:
        known = known.sortWithinPartitions("file", "block", "at")
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("part", pa.int64()), ("record", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting, held, state = Quoting(sep), [], None

        def batches_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def piece(closed: bool) -> list[tuple]:
            # What began in an earlier block is a piece, and so is what is still open at the end of this one.
            whole = closed and state["of"][0] == state["block"]
            return [(state["file"], *state["of"], state["block"], "\n".join(held))] if held and whole == wholes else []

        for file, block, batch, fresh in _runs(batches):
            if fresh:
                if state:
                    yield from batches_of(piece(not state["inside"]))
                first = [batch.column(i)[0].as_py() for i in (3, 4, 5)]
                state, held = {"file": file, "block": block, "inside": first[0], "of": first[1:], "line": 0}, []
            text, line, out = batch.column(2), state["line"], []
            after = {i: quoting.after(text[i].as_py()) for i in _quoted(text).tolist()}
            if not after and not state["inside"]:
                # Every line is a record; what is held ended with the line before.
                yield from batches_of(piece(True))
                held, n = [], len(text)
                if wholes:
                    place = (np.full(n, block), np.arange(line, line + n), np.full(n, block))
                    yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, place), text], schema=schema)
            else:
                for i, value in enumerate(text.to_pylist()):
                    if not state["inside"]:
                        out += piece(True)
                        held, state["of"] = [], [block, line + i]
                    held.append(value)
                    if i in after:
                        state["inside"] = after[i][state["inside"]]
                yield from batches_of(out)
            state["line"] = line + len(text)
        if state:
            yield from batches_of(piece(not state["inside"]))

    return known.mapInArrow(run, "file string, block long, line long, part long, record string")


def read_records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """``file``, ``block``, ``line`` and ``record`` (its text, line ends inside included) of every record.

    Blank records are left out.  A file that ends inside of quotes is refused.  The files are read for
    the state of the blocks, which is a written table of a row a block, for whole records and for those that cross.
    """
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    lines = _lines(spark, path)
    starts = written(block_starts(block_states(lines, sep)), "record-blocks")
    last = starts.groupBy("file").agg(F.max_by("ends_inside", "block").alias("open")).filter("open").select("file").limit(1).collect()
    if last:
        raise ValueError(f"a quoted field is never closed in {last[0][0]}")
    crossing = _pieces(lines, starts, sep, wholes=False).groupBy(*POSITION).agg(F.array_sort(F.collect_list(F.struct("part", "record"))).alias("parts"))
    joined = crossing.select(*POSITION, F.array_join("parts.record", "\n").alias("record"))
    records = _pieces(lines, starts, sep, wholes=True).select(*POSITION, "record").unionByName(joined)
    return records.select(*POSITION, F.regexp_replace("record", "\r\\z", "").alias("record")).filter(F.trim("record") != "")


def has_quoted_line_ends(spark: SparkSession, path: str | list[str], sep: str = ",") -> bool:
    """Whether any line, taken for a record of its own, leaves a quoted field open; one scan, no shuffle."""
    s = sep if sep.isalnum() else f"\\{sep}"
    field = rf'(?:"(?:[^"]|"")*+"[^{s}]*+|[^"{s}][^{s}]*+)?'
    line = F.col("value")
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.filter(line.contains('"') & line.rlike(rf'\A(?:{field}{s})*+"(?:[^"]|"")*+\z')).limit(1).isEmpty()
