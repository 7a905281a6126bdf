import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = tc.read_model(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MACHINE = tc.Transducer(tc.Vocabulary(MODEL))
PIECES = list(MACHINE.vocabulary.scores)
TEXTS = (
    st.text(st.characters(exclude_categories=["Cs"]), max_size=40)
    | st.text(st.sampled_from("etaoins ▁\n."), max_size=120)
    | st.text(st.sampled_from("a ▁"), max_size=60)
    | st.lists(st.sampled_from(PIECES), max_size=15).map("".join)
)


@settings(deadline=None, max_examples=1500)
@given(TEXTS, st.sampled_from([1, 2, 7, 30, tc.CHUNK]))
def test_counts_are_those_of_the_library(text, chunk):
    assert tc.count_tokens(MACHINE, text, chunk) == len(LIBRARY.encode(text))


@settings(deadline=None, max_examples=300)
@given(TEXTS, TEXTS, TEXTS)
def test_maps_compose_in_any_grouping(a, b, c):
    texts = [t.replace(" ", tc.SPACE) for t in (a, b, c)]
    before = ["", texts[0][-1:], (texts[0] + texts[1])[-1:]]
    maps = [tc.state_map(MACHINE, p, t) if t else tc.StateMap("") for p, t in zip(before, texts)]
    whole = tc.run(MACHINE.start, "".join(texts))
    assert maps[0].then(maps[1]).then(maps[2])(MACHINE.start) == whole
    assert maps[0].then(maps[1].then(maps[2]))(MACHINE.start) == whole
    assert tc.composed(maps)(MACHINE.start) == whole


def test_pairs_decide_an_encoding():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("abcdest▁") for _ in range(rng.randrange(1, 25)))
        parts = MACHINE.vocabulary.merged(text)
        assert all(MACHINE.vocabulary.agree(a, b) for a, b in zip(parts, parts[1:]))


def test_states_can_be_dropped(monkeypatch):
    monkeypatch.setattr(tc, "HELD_STATES", 50)
    monkeypatch.setattr(tc, "HELD_WORDS", 5)
    machine = tc.Transducer(tc.Vocabulary(MODEL))
    texts = ["The river runs under the old bridge. " * 3, "électricité 中文 xx", "The river again"]
    assert [tc.count_tokens(machine, t, 16) for t in texts] == [len(LIBRARY.encode(t)) for t in texts]


def test_rows(edge_docs, edge_rows, no_docs):
    found = tc.token_counts(edge_docs, MODEL, limit=100).collect()
    plain = [(i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in edge_rows]
    want = sorted([(i, b, n, n > 100) for i, b, n in plain], key=str)
    assert sorted(map(tuple, found), key=str) == want
    assert any(r.over_limit for r in found) and not all(r.over_limit for r in found)
    assert tc.token_counts(no_docs, MODEL, limit=100).count() == 0


def test_one_long_word():
    text = "ab" * 150_000
    assert tc.count_tokens(MACHINE, text) == len(LIBRARY.encode(text))


def test_other_models_are_refused():
    from sievework.llm import bpe

    with pytest.raises(ValueError):
        tc.Vocabulary(bpe.serialised_model([bytes([b]) for b in range(256)]))


def test_query(spark, sf_dir="/root/testdata/sf0.001"):
    from sievework.llm import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op12_token_transducer(spark, sf_dir).collect():
        assert r.n_tokens == len(LIBRARY.encode(docs[r.doc_id])) and r.over_limit == (r.n_tokens > 4096)
