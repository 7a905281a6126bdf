import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import chat

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    DEFINITION = file.read()
TEXTS = st.lists(st.sampled_from(list("ab \\\n<>[]/|é😀.") + list(chat.CONTROL) + ["\\" + chat.CLOSE]), max_size=12).map("".join) | st.text(st.characters(exclude_categories=["Cs"]), max_size=20)


@given(TEXTS)
def test_escapes_are_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "</s>"]), TEXTS), max_size=5))
def test_masks_hold_learned_texts_only(turns):
    import numpy as np

    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    found = chat.offset_tokenizer(DEFINITION).encode(formatted, add_special_tokens=False)
    offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
    mask = chat.loss_mask(offsets[:, 0], offsets[:, 1], spans)
    assert chat.learned_text(formatted, offsets[:, 0], offsets[:, 1], mask) == "".join(t for r, t in turns if r == "assistant")


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [
        (1, 1, "assistant", "second </s>", 0),
        (1, 0, "user", "first", 0),
        (1, 0, "user", "first", 0),
        (1, 0, "assistant", "before the user by role", 0),
        (2, None, None, None, 0),
        (2, 5, "assistant", None, 0),
        (3, 0, "assistant", "long " * 20_000, 0),
        (None, 0, "assistant", "no number", 0),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids int").repartition(3)


def test_rows(spark, conversations):
    read = {r.conv_id: r for r in chat.read_back(chat.format_conversations(conversations, DEFINITION)).collect()}
    assert list(zip(read[1].roles, read[1].texts)) == [("assistant", "before the user by role"), ("user", "first"), ("user", "first"), ("assistant", "second </s>")]
    assert read[1].learned == "before the user by role" + "second </s>"
    assert list(zip(read[2].roles, read[2].texts)) == [("", ""), ("assistant", "")] and read[2].learned == ""
    assert read[3].learned == "long " * 20_000
    assert read[None].texts == ["no number"]
    empty = conversations.limit(0)
    assert chat.read_back(chat.format_conversations(empty, DEFINITION)).count() == 0
