import base64
import random

import public_tokenizers
import tiktoken

from sievework.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_any_text_encodes_as_the_rank_file_says():
    codec, expected, rng = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN), reference(), random.Random(3)
    letters = "abcdeithnos 's\n\t  éüñ中文😀09.,!%▁\x00\x1fĀ<|endoftext|>"
    for _ in range(2_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
        ids = codec.encode(text)
        assert ids.tolist() == expected.encode_ordinary(text)
        assert codec.decode(ids).tobytes() == text.encode()


def test_long_texts_are_cut_piecemeal(monkeypatch):
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = "several words, 12 numbers\n\n  and spaces " * 50
    whole = codec.encode(text).tolist()
    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    monkeypatch.setattr(bpe, "BLOCK", 7)
    assert codec.encode(text).tolist() == whole


def test_rows(spark, edge_docs, edge_rows, no_docs):
    tokens, expected = bpe.read_ranks(PATH), reference()
    found = bpe.encode(edge_docs, tokens, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r.doc_id or 0), r.ids, bytes(r.decoded)) for r in found.collect())
    assert got == sorted(((i or 0), expected.encode_ordinary(t or ""), (t or "").encode()) for i, t in edge_rows)
    assert bpe.encode(no_docs, tokens, public_tokenizers.PATTERN).count() == 0
