"""Chat formatting with loss masks that follow token offsets.

A conversation is rendered whole: ``<s>`` role ``[INST]`` text ``[/INST]</s>`` for each turn in
order.  Inside roles and texts a backslash is doubled and a control string gets a backslash after
its first character, so that what stands in a text is never taken for the template and comes
back unchanged.  The control strings are added tokens, so no other token crosses the border of a
text.  The rendered conversation is encoded once, with offsets; the spans of the turns to learn
from are sorted, and binary search in the token offsets gives the tokens of each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import covered, list_array

#: Template: start of a turn, start of its text, end of its text, end of the turn.
OPEN, BEGIN, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, BEGIN, END, CLOSE)
LEARNED_ROLE = "assistant"
#: Characters encoded at once; no effect on results.
BLOCK = 1 << 18
#: Conversations read back at once; no effect on results.
ROWS = 256

_ESCAPED = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_PLAIN = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(BEGIN)}(.*?){re.escape(END)}{re.escape(CLOSE)}", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"\1", text)


def render(turns: list[tuple[str, str]], learned: str = LEARNED_ROLE) -> tuple[str, np.ndarray]:
    """Formatted conversation and the sorted spans (start, end) of the texts to learn from."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{BEGIN}", escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, CLOSE]
        at += len(head) + len(body) + len(END) + len(CLOSE)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens that intersect a span; token starts and ends are sorted, and so are the spans."""
    low = np.searchsorted(ends, spans[:, 0], "right")
    high = np.searchsorted(starts, spans[:, 1], "left")
    some = (spans[:, 1] > spans[:, 0]) & (high > low)
    return covered(low[some], high[some], len(starts))


def learned_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """Text under a loss mask, one run of covered characters after the other, unescaped."""
    under = covered(starts[mask], ends[mask], len(formatted))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], under.astype(np.int8), [0]))))
    return "".join(unescape(formatted[a:b]) for a, b in edges.reshape(-1, 2).tolist())


def offset_tokenizer(definition: str):
    """Tokenizer of a definition file's text, with the control strings added and offsets of whole tokens."""
    from tokenizers import Tokenizer

    def whole(part) -> None:
        # Offsets must cover white space too.
        if isinstance(part, dict):
            if "trim_offsets" in part:
                part["trim_offsets"] = False
            for value in part.values():
                whole(value)
        elif isinstance(part, list):
            for value in part:
                whole(value)

    described = json.loads(definition)
    whole(described)
    tokenizer = Tokenizer.from_str(json.dumps(described))
    tokenizer.add_special_tokens(list(CONTROL))
    return tokenizer


FORMATTED = "formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def format_conversations(df: DataFrame, definition: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``formatted`` and its tokens: ``ids``, character offsets ``starts`` and ``ends``, ``loss``.

    Turns go by number, null first, then by role and text, so that ties and repeated rows have one
    order and all stay.  A null role or text is an empty one; rows with a null conversation are
    one conversation.  A conversation is one sequence, so it is gathered in one row; other columns are not
    read.  ``definition`` (a tokenizer file's text) goes to the tasks once.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)
    kind = df.schema[conv].dataType.simpleString()
    rows = df.select(
        F.col(conv).alias("key"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("row"),
    )
    gathered = rows.groupBy("key").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    turns = gathered.select("key", F.col("rows.role").alias("roles"), F.col("rows.text").alias("texts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = offset_tokenizer(shared.value)

        def encoded(keys: list, texts: list[str], spans: list[np.ndarray]) -> pa.RecordBatch:
            found = tokenizer.encode_batch(texts, add_special_tokens=False)
            offsets = [np.array(f.offsets, np.int64).reshape(-1, 2) for f in found]
            masks = [loss_mask(o[:, 0], o[:, 1], s) for o, s in zip(offsets, spans)]
            n, flat = np.array([len(o) for o in offsets], np.int64), np.concatenate(offsets)
            ids = np.concatenate([np.array(f.ids, np.int32) for f in found])
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type), pa.array(texts, pa.string()), list_array(ids, n, pa.int32()), list_array(flat[:, 0], n, pa.int32()), list_array(flat[:, 1], n, pa.int32()), list_array(np.concatenate(masks), n, pa.bool_())],
                names=["key", "formatted", "ids", "starts", "ends", "loss"],
            )

        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, len(whole), ROWS)):
            key_type, keys, texts, spans, size = batch.column(0).type, [], [], [], 0
            for key, roles, bodies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                formatted, found = render(list(zip(roles.as_py(), bodies.as_py())))
                keys.append(key)
                texts.append(formatted)
                spans.append(found)
                size += len(formatted)
                if size >= BLOCK:
                    yield encoded(keys, texts, spans)
                    keys, texts, spans, size = [], [], [], 0
            if keys:
                yield encoded(keys, texts, spans)

    return turns.mapInArrow(run, f"key {kind}, {FORMATTED}").withColumnRenamed("key", conv)


def read_back(df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv``, ``formatted``, ``roles`` and ``texts`` of its turns and ``learned``, the text under the loss mask."""
    kind = df.schema[conv].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, len(whole), ROWS)):
            roles, texts, learned = [], [], []
            for formatted, starts, ends, loss in zip(*(batch.column(i) for i in range(1, 5))):
                turns = parse(formatted.as_py())
                roles.append([r for r, _ in turns])
                texts.append([t for _, t in turns])
                place = (x.values.to_numpy().astype(np.int64) for x in (starts, ends))
                learned.append(learned_text(formatted.as_py(), *place, np.array(loss.as_py(), bool)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())), pa.array(learned, pa.string())], names=["key", "formatted", "roles", "texts", "learned"])

    rows = df.select(F.col(conv).alias("key"), "formatted", "starts", "ends", "loss")
    return rows.mapInArrow(run, f"key {kind}, formatted string, roles array<string>, texts array<string>, learned string").withColumnRenamed("key", conv)
