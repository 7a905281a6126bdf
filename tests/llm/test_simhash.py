import random
import re

import numpy as np
import pytest
import xxhash

from sievework.llm import graph, simhash


def plain_fingerprint(text, words=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + words]).encode(), 42) for i in range(max(1, len(w) - words + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(values, radius):
    label = list(range(len(values)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(values):
        for j, b in enumerate(values[:i]):
            if bin(a ^ b).count("1") <= radius and root(i) != root(j):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(values))]


def test_rows(edge_docs, edge_rows):
    found = simhash.near_duplicates(edge_docs).collect()
    prints = [plain_fingerprint(t) for _, t in edge_rows]
    groups = plain_groups(prints, 4)
    lowest = {}
    for (i, _), g in zip(edge_rows, groups):
        if i is not None:
            lowest[g] = min(lowest.get(g, i), i)
    got = sorted((r.doc_id or 0, r.fp % 2**64, r.component_id or 0) for r in found)
    assert got == sorted((i or 0, p, lowest.get(g, 0)) for (i, _), p, g in zip(edge_rows, prints, groups))


@pytest.mark.parametrize("bits", [6, 12, 40])
def test_index_finds_all_links(bits):
    """Few free bits make many near fingerprints, ties and deep trees."""
    rng = random.Random(bits)
    fps = sorted({rng.getrandbits(bits) << rng.choice([0, 20]) for _ in range(400)})
    fps = np.array(fps, np.uint64)
    buckets = (fps >> np.uint64(3)) % np.uint64(5)
    order = np.lexsort((simhash.gray_rank(fps), buckets))
    fps, buckets = fps[order], buckets[order]
    got = sorted(tuple(p) for a, b in simhash.GrayIndex(buckets, fps).links(4) for p in zip(a.tolist(), b.tolist()))
    apart = lambda i, j: bin(int(fps[i]) ^ int(fps[j])).count("1")
    assert got == [(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if buckets[i] == buckets[j] and apart(i, j) <= 4]


def test_gray_rank_inverts_the_code():
    n = np.arange(5_000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("rows", [10, 10**8, 10**10])
def test_any_choice_of_blocks_gives_the_same_groups(spark, rows, monkeypatch):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(k)) for b in base for k in (0, 2, 3, 4, 5)})
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    keys = simhash.bucket_keys
    monkeypatch.setattr(simhash, "bucket_keys", lambda fp, radius, n: keys(fp, radius, rows))
    edges = graph.components(simhash.linked_groups(df, 4)).collect()
    root = {r.a % 2**64: r.b % 2**64 for r in edges}
    found = [root.get(v, v) for v in values]
    expected = plain_groups(values, 4)
    assert [found.index(f) for f in found] == [expected.index(e) for e in expected]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501)], "a long, b long")
    got = {r.a: r.b for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_one_of_each(edge_docs, edge_rows, no_docs):
    kept = simhash.one_of_each(edge_docs)
    assert set(kept.columns) == set(edge_docs.columns)
    found = simhash.near_duplicates(edge_docs).collect()
    expected = sorted({r.doc_id for r in found if r.doc_id is not None and r.doc_id == r.component_id})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == expected
    assert kept.filter("doc_id IS NULL").count() == 2
    assert simhash.one_of_each(no_docs).count() == 0
