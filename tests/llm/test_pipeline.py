"""Every stage on its own input, and the whole, against brute force."""

import base64
import sys
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from test_decontam import plain_leaks
from test_simhash import plain_fingerprint, plain_groups
from test_spans import plain

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from sievework.llm import line_quality  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, corpus_pipeline.written(stage(spark, out[-1][1], SF), name)))
    return {name: (before.collect(), after.collect(), after.columns) for (_, before), (name, after) in zip(out, out[1:])}


def test_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality-rules", "near-duplicates", "repeated-strings", "benchmark-leaks", "token-ids"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name][2] == columns


def test_quality(spark, stages):
    before, after, _ = stages["quality-rules"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = line_quality.fit_on_labels(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in line_quality.assess(docs, model).collect() if r.kept}
    assert sorted(after) == sorted(r for r in before if r.doc_id in kept)


def test_near_duplicates(stages):
    before, after, _ = stages["near-duplicates"]
    before = sorted(before)
    groups = plain_groups([plain_fingerprint(r.text) for r in before], 4)
    assert sorted(after) == [r for i, r in enumerate(before) if groups[i] == i]


def test_repeated_strings(stages):
    before, after, _ = stages["repeated-strings"]
    expected = {i: k.decode("utf-8", "ignore") for i, _, _, _, k in plain([(r.doc_id, r.text) for r in before], lambda t: t.encode(), 50, bytes)}
    others = {r.doc_id: (r.lang, r.source) for r in before}
    assert len(after) == len(before)
    for r in after:
        assert (r.text, r.n_chars, r.lang, r.source) == (expected[r.doc_id], len(expected[r.doc_id]), *others[r.doc_id])


def test_leaks(spark, stages):
    before, after, _ = stages["benchmark-leaks"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {i for i, *_ in plain_leaks([(r.doc_id, r.text) for r in before], items)}
    assert sorted(after) == sorted(r for r in before if r.doc_id not in leaked)


def test_tokens(stages):
    before, after, _ = stages["token-ids"]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id: r.ids for r in after} == {r.doc_id: reference.encode_ordinary(r.text) for r in before}


def test_run_is_the_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(stages["token-ids"][1])


def test_stages_on_no_documents(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_on_odd_rows(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, SF).columns == docs.columns
