"""Both span removers against brute force."""

import random
import re

import numpy as np
import pytest

from sievework.llm import suffix_dedup, superkmer


def plain(rows, pieces, window, glue):
    """Per distinct (id, text): number of pieces, removed ones, removed runs, what is kept."""
    docs = sorted({(i, t or "") for i, t in rows if i is not None})
    holder = {}
    for i, t in docs:
        p = pieces(t)
        for a in range(len(p) - window + 1):
            holder.setdefault(tuple(p[a : a + window]), i)
    out = {}
    for i, t in {(i, t or "") for i, t in rows}:
        p = pieces(t)
        gone = [False] * len(p)
        if i is not None:
            for a in range(len(p) - window + 1):
                if holder[tuple(p[a : a + window])] < i:
                    gone[a : a + window] = [True] * window
        runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out[i, t] = (len(p), sum(gone), runs, glue([x for x, g in zip(p, gone) if not g]))
    return sorted(((i or 0), *out[i, t or ""]) for i, t in rows)


def by_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def mixed_rows():
    rng = random.Random(8)
    passages = [" ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice("ab cd ef gh ij kl mn op".split()) for _ in range(rng.randint(0, 60)))]
        if rng.random() < 0.7:
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            parts.insert(rng.randint(0, 1), p[a : a + rng.randint(20, 110)])
        rows.append((rng.randint(0, 80), rng.choice(["\n", " "]).join(parts)))
    return rows


@pytest.mark.parametrize("case", ["edge", "mixed"])
def test_words(spark, edge_docs, edge_rows, case):
    rows = edge_rows if case == "edge" else mixed_rows()
    df = edge_docs if case == "edge" else spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id or 0), r.n_words, r.n_removed, r.kept) for r in superkmer.remove_repeats(df).collect())
    assert got == [(i, n, g, k) for i, n, g, _, k in plain(rows, by_words, 13, " ".join)]


@pytest.mark.parametrize("case", ["edge", "mixed"])
def test_bytes(spark, edge_docs, edge_rows, case):
    rows = edge_rows if case == "edge" else mixed_rows()
    df = edge_docs if case == "edge" else spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id or 0), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect())
    assert got == plain(rows, lambda t: t.encode(), 50, bytes)


def test_a_window_as_wide_as_the_anchor(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, window=16, kmer=16).collect())
    assert got == plain(rows, lambda t: t.encode(), 16, bytes)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, window=20, kmer=12)


def test_small_pieces_give_the_same(spark, monkeypatch):
    rows = mixed_rows()
    expected = plain(rows, lambda t: t.encode(), 50, bytes)
    monkeypatch.setattr(suffix_dedup, "SORTED", 3)
    monkeypatch.setattr(suffix_dedup, "EXPANDED", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect())
    assert got == expected


def test_no_documents(no_docs):
    assert superkmer.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_texts_keep_their_columns_and_whole_characters(edge_docs, edge_rows):
    got = suffix_dedup.without_repeats(edge_docs)
    assert got.schema == edge_docs.schema
    expected = {(i, n): k.decode("utf-8", "ignore") for i, n, _, _, k in plain(edge_rows, lambda t: t.encode(), 50, bytes)}
    before = {(r.doc_id, r.n_chars): r.text for r in edge_docs.collect()}
    rows = got.collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        text = before[r.doc_id, r.n_chars]
        assert r.text is None if text is None else r.text == expected[r.doc_id or 0, len(text.encode())]
        assert (r.lang, r.key, r.tag, r.fp) == ("en", 0, "x", None)


def test_multikey_order():
    rng = np.random.default_rng(1)
    columns = rng.integers(0, 3, (4, 500)).astype(np.uint64)
    order, fresh = suffix_dedup.multikey_order(columns)
    rows = [tuple(c) for c in columns[:, order].T.tolist()]
    assert rows == sorted(rows)
    assert fresh.tolist() == [i == 0 or rows[i] != rows[i - 1] for i in range(len(rows))]


def test_sliding_minimum():
    values = np.random.default_rng(2).integers(0, 99, 50).astype(np.uint64)
    for width in (1, 2, 5, 11, 35, 50):
        assert superkmer.sliding_minimum(values, width).tolist() == [values[i : i + width].min() for i in range(51 - width)]
