"""Token counts by a finite-state transducer that is compiled from a sentencepiece BPE model.

Merges go by the score of the joined piece, then from the left, so a sequence of pieces is the
encoding of its text exactly if every adjacent pair is the encoding of its own text.  Hence every
prefix of a text has one last piece, and for a new character it is the one piece ending there that agrees
with the last piece before it.  What a state must know is therefore small: the ends of
pieces that may still grow (a node of the trie of pieces each), with the last piece at their
start and the difference in tokens.  States of equal content are one, the transducer is deterministic, and
each transition carries the number of tokens that the count of the prefix grows by (it may be
negative: a longer piece takes the place of several).  States and transitions are compiled when they
are first needed.

Two characters that stand side by side in no piece are never merged, so a state after such a cut does not
depend on what came before.  A text is cut into chunks; each gives a map from the state at
its start to the state at its end and the tokens between: up to the first cut it depends on the
start, after that it is constant.  Maps compose by a parallel prefix scan.  Words between cuts come back
often, so the tokens of a whole word from cut to cut are kept as one transition.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.buffers import chunks

#: What the model format writes for a space.
SPACE = "▁"
#: Characters of a chunk, of a word that is kept, and states and words a task holds before it starts anew; no effect on results.
CHUNK = 1 << 16
LONG_WORD = 64
HELD_STATES = 150_000
HELD_WORDS = 400_000

#: Spaces and letters, or spaces and other characters; superscript digits are no letters.
_LETTER = re.compile(r"[^\W\d_¹²³]")
_WORD = re.compile(rf"{SPACE}*[^\W\d_¹²³]+|{SPACE}*(?:[\d_¹²³]|[^\w{SPACE}])+|{SPACE}+")


class Vocabulary:
    """Pieces and scores of a model, the trie of their prefixes, and plain merging for short texts."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.scores: dict[str, float] = {}
        bytes_known = 0
        for i in range(library.get_piece_size()):
            if library.is_byte(i):
                bytes_known += 1
            elif not (library.is_control(i) or library.is_unknown(i)):
                if library.is_unused(i):
                    raise ValueError("unused pieces are not supported")
                self.scores[library.id_to_piece(i)] = library.get_score(i)
        probe = "a \t  b"
        if bytes_known != 256 or library.decode(library.encode(probe)) != probe or library.encode(" a ", out_type=str)[0][:1] != SPACE:
            raise ValueError("the model must have byte pieces, a dummy prefix and no normalisation")
        #: Nodes of the trie by text; children by character.
        self.children: dict[str, set[str]] = {}
        for piece in self.scores:
            for end in range(len(piece)):
                self.children.setdefault(piece[:end], set()).add(piece[end])
        self.inner = {piece[i : i + 2] for piece in self.scores for i in range(len(piece) - 1)}
        #: Whether the pattern of words only cuts where the pieces do.
        self.words_cut = all(pair == SPACE * 2 or self._kind(pair[1]) != SPACE and self._kind(pair[0]) in (SPACE, self._kind(pair[1])) for pair in self.inner)
        self._agree: dict[tuple[str, str], bool] = {}

    @staticmethod
    def _kind(character: str) -> str:
        return SPACE if character == SPACE else "letter" if _LETTER.match(character) else "other"

    def weight(self, piece: str) -> int:
        """Tokens of a piece: a character without one is written in bytes."""
        return 1 if piece in self.scores else len(piece.encode())

    def merged(self, text: str) -> list[str]:
        """Pieces of a text by the rule itself."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, before: str, piece: str) -> bool:
        """Whether ``piece`` may follow the last piece ``before`` (empty: a cut)."""
        known = self._agree.get((before, piece))
        if known is None:
            if len(self._agree) >= 4 * HELD_STATES:
                self._agree.clear()
            known = self._agree[before, piece] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return known


class State(dict):
    """A state: its transitions by character, each (next state, tokens added)."""

    __slots__ = ("last", "growing", "machine")

    def __missing__(self, character: str) -> tuple["State", int]:
        step = self[character] = self.machine.step(self, character)
        return step


class Words(dict):
    """Tokens of words from cut to cut."""

    def __init__(self, machine: "Transducer"):
        self.machine = machine

    def __missing__(self, word: str) -> int:
        tokens = run(self.machine.start, word)[1]
        if len(word) <= LONG_WORD:
            if len(self) >= HELD_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


class Transducer:
    """States reached so far.  ``growing`` of a state: (trie node, last piece at its start, tokens less)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.words = Words(self)
        self.start = self._state("", (("", "", 0),))

    def _state(self, last: str, growing: tuple) -> State:
        state = self.states.get((last, growing))
        if state is None:
            state = self.states[last, growing] = State()
            state.last, state.growing, state.machine = last, growing, self
        return state

    def step(self, state: State, character: str) -> tuple[State, int]:
        """Next state and the growth of the token count."""
        v = self.vocabulary
        growing = state.growing if state.last + character in v.inner else (("", "", 0),)
        found = None
        grown = []
        for node, before, less in growing:
            longer = node + character
            if found is None and (longer in v.scores or not node) and v.agree(before, longer):
                found = longer, v.weight(longer) - less
            if longer in v.children:
                grown.append((longer, before, less))
        piece, added = found
        # Tokens are counted from the new prefix on.
        grown = [(node, before, less + added) for node, before, less in grown]
        return self._state(character, (*grown, ("", piece, 0))), added


def run(state: State, text: str) -> tuple[State, int]:
    """State after a text and the tokens that it adds."""
    tokens = 0
    for character in text:
        state, added = state[character]
        tokens += added
    return state, tokens


def run_from_cut(machine: Transducer, text: str) -> tuple[State, int]:
    """The same from a cut on; all words but the last one end at a cut as well."""
    words = _WORD.findall(text) if machine.vocabulary.words_cut else [text]
    state, tokens = run(machine.start, words[-1])
    return state, tokens + sum(map(machine.words.__getitem__, words[:-1]))


@dataclass
class StateMap:
    """Effect of a piece of text on a state: ``head`` is run from the state at the start; then, if
    there is a cut, the state is ``end`` whatever it was, and ``tokens`` follow those of the head."""

    head: str
    end: State | None = None
    tokens: int = 0

    def __call__(self, state: State) -> tuple[State, int]:
        state, tokens = run(state, self.head)
        return (state, tokens) if self.end is None else (self.end, tokens + self.tokens)

    def then(self, other: "StateMap") -> "StateMap":
        """The map of this piece of text and the next one."""
        if self.end is None:
            return StateMap(self.head + other.head, other.end, other.tokens)
        end, tokens = other(self.end)
        return StateMap(self.head, end, self.tokens + tokens)


def state_map(machine: Transducer, before: str, text: str) -> StateMap:
    """Map of a chunk that follows the character ``before`` (empty: the start of a text)."""
    inner = machine.vocabulary.inner
    for at, character in enumerate(text):
        if before + character not in inner:
            return StateMap(text[:at], *run_from_cut(machine, text[at:]))
        before = character
    return StateMap(text)


def composed(maps: list[StateMap]) -> StateMap:
    """Composition of all maps in order: the up-sweep of a prefix scan, neighbours in each round."""
    while len(maps) > 1:
        paired = [a.then(b) for a, b in zip(maps[::2], maps[1::2])]
        maps = paired + maps[len(paired) * 2 :]
    return maps[0]


def count_tokens(machine: Transducer, text: str, chunk: int = CHUNK) -> int:
    """Tokens of a whole text."""
    if not text:
        return 0
    text = SPACE + text.replace(" ", SPACE)
    if len(machine.states) > HELD_STATES:
        machine.clear()
    if len(text) <= chunk:
        return run_from_cut(machine, text)[1]
    maps = [state_map(machine, text[low - 1 : low], text[low : low + chunk]) for low in range(0, len(text), chunk)]
    return composed(maps)(machine.start)[1]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def token_counts(df: DataFrame, model: bytes, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of every row.

    Counts are those of the sentencepiece library for the whole text, without begin or end; a null
    text is an empty one and has none.  Rows, repeated ones and those without a key included, stay as they are;
    other columns are not read, so their names cannot clash.  One narrow stage: the model goes to the tasks once.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None
        for batch in batches:
            machine = machine or Transducer(Vocabulary(shared.value))
            for low, high, data, offsets in chunks(batch.column(1)):
                texts = (data[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                tokens = np.fromiter((count_tokens(machine, t) for t in texts), np.int64, high - low)
                columns = [batch.column(0).slice(low, high - low), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "n_tokens", "over_limit"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("key", key)
