"""Repair of conversations at the least cost: a shortest path decided by the minimum of whole numbers.

A repaired conversation has the role initials ``(s?(ua)+)?``.  A node of the path is a row and a state of that
pattern; an edge is an edit, one letter: Keep, Rerole, Delete, Insert.  The value of a node is one
big integer: its high part is the cost of the cheapest way to the end, and below it the letters of
that way stand as digits of fixed width, the first letter highest, filled up with zeros behind the last.  An
edge adds its cost and its letter and moves the digits behind down by one place, so the
ordinary minimum prefers the least cost and then the ASCII-least letters, a shorter sequence first.

Faults are found by Spark, so only a byte of each row goes to the path search, rows of a
conversation in order; decisions then travel ahead of the texts, which stream past them.  A
conversation is one sequence: its rows pass through one task, but are never held there as texts.  Time
of the path search grows with the square of the rows of one conversation (digits times rows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.scratch import written

#: Costs and letters of the edits, what an undeleted truncated row adds, and the roles that can be written.
KEEP, REROLE, DELETE, INSERT = (0, "K"), (2, "R"), (3, "D"), (2, "I")
TRUNCATED_COST = 1
USER, ASSISTANT = "user", "assistant"
#: Digits are the places of the letters in this order; zero is the filling.
LETTERS = "\0" + "".join(sorted(letter for _, letter in (KEEP, REROLE, DELETE, INSERT)))
#: Bits of a digit.
WIDTH = 3
#: State of the pattern after each initial: 0 nothing, 1 system, 2 user, 3 assistant.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
#: State and role of what is written in each state.
WRITTEN = {0: (2, USER), 1: (2, USER), 2: (3, ASSISTANT), 3: (2, USER)}
#: Code of a row: kind of fault times four plus the place of its initial here.
INITIALS = "-sua"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {"su", "ua", "au"}

PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_ORDER = ["turn", "was", "digest", "copy"]


def least_edits(codes: bytes | bytearray) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of rows with these codes."""
    places = 2 * len(codes) + 3
    shift = WIDTH * places
    low = (1 << shift) - 1
    digit = {letter: LETTERS.index(letter) << (shift - WIDTH) for letter in LETTERS[1:]}
    edge = {(cost, letter): (cost << shift) + digit[letter] for cost, letter in (KEEP, REROLE, DELETE, INSERT)}
    late = {(cost, letter): weight + (TRUNCATED_COST << shift) for (cost, letter), weight in edge.items()}
    none = (10 * len(codes) + 100) << shift

    def behind(value: int) -> int:
        """A value with its digits moved down by one."""
        return (value >> shift << shift) | ((value & low) >> WIDTH)

    def with_inserts(values: list[int]) -> list[int]:
        """Values before any inserts: one after each state that needs an assistant, then after the others."""
        once = [min(values[s], edge[INSERT] + behind(values[WRITTEN[s][0]])) for s in range(4)]
        return [min(once[s], edge[INSERT] + behind(once[WRITTEN[s][0]])) for s in range(4)]

    values = with_inserts([0 if s in ACCEPTED else none for s in range(4)])
    for code in reversed(codes):
        fault, initial = code >> 2, INITIALS[code & 3]
        after = [behind(v) for v in values]
        rows = [edge[DELETE] + after[s] for s in range(4)]
        if fault in (FINE, TRUNCATED):
            weights = late if fault == TRUNCATED else edge
            for s in range(4):
                rows[s] = min(rows[s], weights[REROLE] + after[WRITTEN[s][0]])
                if (s, initial) in NEXT:
                    rows[s] = min(rows[s], weights[KEEP] + after[NEXT[s, initial]])
        values = with_inserts(rows)
    letters = []
    digits, place = values[0] & low, shift
    while digits:
        place -= WIDTH
        letters.append(LETTERS[digits >> place])
        digits &= (1 << place) - 1
    return values[0] >> shift, "".join(letters)


def edited(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """Rows (role, text) after the edits of an audit."""
    rows, state = iter(rows), 0
    for letter in audit:
        if letter == INSERT[1]:
            state, role = WRITTEN[state]
            yield role, ""
            continue
        role, text = next(rows)
        if letter == DELETE[1]:
            continue
        state, role = WRITTEN[state] if letter == REROLE[1] else (NEXT[state, role[:1]], role)
        yield role, text


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The damage that ``op13`` prescribes, by crc32 of ``conv:turn``; dropped rows stay, with ``gone`` set.

    A null role or text, and a null turn inside the checksum, is one space.
    """
    space = F.lit(" ")
    at = F.concat_ws(":", F.col(conv).cast("string"), F.coalesce(F.col(turn).cast("string"), space))
    what = F.crc32(at) % 20
    body = F.coalesce(F.col(text).cast("string"), space)
    body = F.when(what == 1, "").when(what == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body)
    said = F.coalesce(F.col(role).cast("string"), space)
    rows = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.when(what == 4, USER).otherwise(said).alias("role"),
        body.alias("text"),
        (what == 0).alias("gone"),
        F.when(what == 3, 2).otherwise(1).alias("copies"),
        said.alias("was"),
        F.md5(F.coalesce(F.col(text).cast("string"), space)).alias("digest"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def undamaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as they are, in the form that ``plans`` and ``repaired`` take; a null role or text is one space."""
    said, body = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    return df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), said.alias("role"), body.alias("text"), F.lit(False).alias("gone"), said.alias("was"), F.md5(body).alias("digest"), F.lit(1).alias("copy")
    )


def _coded(rows: DataFrame) -> DataFrame:
    """Order of the rows and ``code``, their fault and initial; a repeated row is one from its second place in the
    conversation on.  What texts say of themselves is read off first, so no text is shuffled."""
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    initial = F.greatest(F.instr(F.lit(INITIALS[1:]), F.substring("role", 1, 1)), F.lit(0))
    initial = F.when(F.substring("role", 1, 1) == "", 0).otherwise(initial)
    read = rows.select("conv", *_ORDER, "gone", same.alias("same"), fault.alias("fault"), initial.alias("initial"))
    earlier = F.row_number().over(W.partitionBy("conv", "same", "gone").orderBy(*_ORDER)) > 1
    fault = F.when(earlier & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))
    return read.withColumn("code", (fault * 4 + F.col("initial")).cast("int"))


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows of one conversation, as they stream by; a run must be read to its end."""
    rows = (row for batch in batches for low in range(0, len(batch), 4096) for row in zip(*(c.to_pylist() for c in batch.slice(low, 4096).columns)))
    head = next(rows, None)

    def run(key: object) -> Iterator[tuple]:
        nonlocal head
        while head is not None and head[0] == key:
            yield head
            head = next(rows, None)

    while head is not None:
        yield head[0], run(head[0])


def _in_batches(found: Iterable[tuple], schema: pa.Schema, rows: int = 1024, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length and text."""
    held, weight = [], 0
    for row in found:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= rows or weight >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _key_type(df: DataFrame, conv: str) -> tuple[str, pa.DataType]:
    kind = df.schema[conv].dataType
    names = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}
    return kind.simpleString(), names[kind.simpleString()]


def plans(rows: DataFrame) -> DataFrame:
    """``conv``, its counts of gaps and faults, and cost and letters of its cheapest edits.

    ``rows`` come from ``damaged`` or ``undamaged``.  Turns go by number, null first, then by the
    role and a digest of the text they had, repeats adjacent.  A conversation without a row left has zeros and no letters; rows
    without a conversation belong to none.
    """
    kind, key_type = _key_type(rows, "conv")
    schema = pa.schema([("conv", key_type), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])

    def planned(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for key, run in _grouped(batches):
            codes, low, high, turns, counts, illegal, before = bytearray(), None, None, 0, [0] * 4, 0, None
            for _, turn, code, gone in run:
                if gone:
                    continue
                if turn is not None:
                    low = turn if low is None else low
                    turns += turn != high
                    high = turn
                initial = INITIALS[code & 3]
                illegal += before is not None and before + initial not in LEGAL
                before = initial
                counts[code >> 2] += 1
                codes.append(code)
            gaps = 0 if low is None else high - low + 1 - turns
            yield key, gaps, *counts[1:], illegal, *least_edits(codes)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(planned(batches), schema)

    ordered = _coded(rows.filter("conv IS NOT NULL")).repartition("conv").sortWithinPartitions("conv", *_ORDER).select("conv", "turn", "code", "gone")
    return ordered.mapInArrow(work, f"conv {kind}, {PLAN}")


def _streamed(rows: DataFrame, planned: DataFrame, use: Callable, schema: str) -> DataFrame:
    """``use`` on the decisions and texts of every conversation, decisions first."""
    texts = rows.filter("conv IS NOT NULL AND NOT gone").select("conv", F.lit(1).alias("kind"), *_ORDER, "role", "text")
    ahead = planned.select("conv", F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(c) for c, t in zip(_ORDER, ("long", "string", "string", "int"))), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = ahead.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", *_ORDER).select("conv", "role", "text")
    return both.mapInArrow(use, schema)


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv``, ``place`` (from 0), ``role`` and ``text`` of the repaired conversations."""
    kind, key_type = _key_type(rows, "conv")
    schema = pa.schema([("conv", key_type), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for key, run in _grouped(batches):
            audit = next(run)[2]
            for place, (role, text) in enumerate(edited((r[1:] for r in run), audit)):
                yield key, place, role, text
            for _ in run:
                pass

    def use(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(found(batches), schema)

    return _streamed(rows, planned, use, f"conv {kind}, place long, role string, text string")


def repaired_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv`` and SHA-256 of its repaired turns, ``role:text`` joined by line ends, as they stream by."""
    kind, key_type = _key_type(rows, "conv")
    schema = pa.schema([("conv", key_type), ("repaired_sha256", pa.string())])

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for key, run in _grouped(batches):
            audit, whole = next(run)[2], hashlib.sha256()
            for place, (role, text) in enumerate(edited((r[1:] for r in run), audit)):
                whole.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            for _ in run:
                pass
            yield key, whole.hexdigest()

    def use(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(found(batches), schema)

    return _streamed(rows, planned, use, f"conv {kind}, repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written plans of the rows, and the repaired turns."""
    planned = written(plans(rows), "repair-plans")
    return planned, repaired(rows, planned)
