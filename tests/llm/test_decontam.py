import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.llm import decontam


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", (text or "").lower()) if w]


def plain_leaks(docs, items, threshold=0.8):
    """All windows of the item's size; a shorter document is one window."""
    out = {}
    for i, a in {(i, t) for i, t in docs if i is not None}:
        for j, b in items:
            b = words(b)
            if not b or j is None:
                continue
            size = min(5, len(b))
            grams = lambda w: [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]  # noqa: B023,E731
            mine, other = grams(words(a)), grams(b)
            n = min(len(mine), len(other))
            for s in range(len(mine) - n + 1) if n else []:
                common = sum((Counter(mine[s : s + n]) & Counter(other)).values())
                share = common / (n + len(other) - common)
                if share >= threshold:
                    out[i, j] = max(out.get((i, j), 0), share)
    return sorted((i, j, round(s, 9)) for (i, j), s in out.items())


@pytest.fixture(scope="module")
def case():
    item = " ".join(f"w{i}" for i in range(50))
    changed = item.split()
    items = [(0, item), (1, "a b c"), (2, None), (3, ""), (4, "x y " * 15), (5, item.upper()), (None, "seven eight nine ten eleven twelve")]
    docs = [
        (1, "before " + item + " after"),
        (2, item),
        (3, "pre " + " ".join([*changed[:2], *changed[3:]]) + " post"),
        (4, " ".join([*changed[:20], "new", *changed[20:]])),
        (5, " ".join(changed[:49])),
        (6, " ".join([*changed[:20], "new", *changed[21:]])),
        (7, " ".join(changed[1:]) + " end"),
        (8, "start " + " ".join(changed[:48]) + " end"),
        (9, "only A B C here"),
        (10, "x y " * 300),
        (11, None),
        (12, ""),
        (13, item),
        (13, item),
        (14, "w1 w2 w3 w4 w5 w6"),
        (15, "seven eight nine ten eleven twelve"),
        (None, item),
    ]
    return docs, items


def test_against_all_windows(spark, case):
    docs, items = case
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in docs], "doc_id long, text string, key int, n int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.leaks(df, bench).collect()
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in found) == plain_leaks(docs, items)
    assert {r.start for r in found if r.doc_id in (1, 13) and r.item_id == 0} == {1, 0}


def test_shuffled_join_gives_the_same(spark, case, monkeypatch):
    docs, items = case
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([x for x in items if x[0] is not None], "item_id long, text string")
    monkeypatch.setattr(decontam, "SENT_SHINGLES", 0)
    got = sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontam.leaks(df, bench).collect())
    assert got == plain_leaks(docs, [x for x in items if x[0] is not None])


def test_nothing_to_find(spark, no_docs):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontam.leaks(no_docs, bench).count() == 0
    none = decontam.leaks(no_docs, bench.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "item_id", "start", "similarity"]


def test_fingerprint_bits(spark):
    hashes = [1, 3, -1, 7, -(2**63)]
    df = spark.createDataFrame([(hashes,), ([],), ([5] * 3000,)], "h array<long>").select(decontam.fingerprint(F.col("h")).alias("fp"))
    plain = lambda hs: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert [r.fp % 2**64 for r in df.collect()] == [plain(hashes), 0, 5]


def test_no_window_of_the_similarity_is_lost(spark):
    """Repetitive items, each in a document at the very edge of the similarity."""
    rng, items, docs = random.Random(5), [], []
    for i in range(150):
        phrase = [f"p{i}", f"q{i}"]
        item = phrase * rng.randrange(3, 20) + [f"w{i}x{k}" for k in range(rng.randrange(20, 54))] + phrase * rng.randrange(3, 20)
        n, cut = len(item) - 4, 0
        for cut in range(1, 40):
            at = rng.randrange(len(item) - cut)
            other = item[:at] + [f"z{i}x{k}" for k in range(cut)] + item[at + cut :]
            if len(plain_leaks([(i, " ".join(other))], [(i, " ".join(item))])) == 0:
                break
            docs.append((1000 * i + cut, "before it " + " ".join(other) + " after it"))
        items.append((i, " ".join(item)))
    want = sorted(x for i, t in docs for x in plain_leaks([(i, t)], [items[i // 1000]]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = decontam.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(want) > 400
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in found) == want


def test_bits_that_cannot_differ(spark):
    rng = random.Random(2)
    n, most = 40, int(2 * 40 * 0.2 / 1.8 + 1e-9)
    item = [rng.getrandbits(64) - 2**63 for _ in range(3)] * 10 + [rng.getrandbits(64) - 2**63 for _ in range(10)]
    others = [item[most // 2 :] + [rng.getrandbits(64) - 2**63 for _ in range(most // 2)] for _ in range(50)] + [item[most:]]
    df = spark.createDataFrame([(h,) for h in others], "h array<long>").select(decontam.fingerprint(F.col("h")).alias("fp"))
    own = spark.createDataFrame([(item,)], "h array<long>").select(decontam.fingerprint(F.col("h")).alias("fp"), decontam.certain_bits(F.col("h"), 0.8).alias("block")).first()
    assert len(item) == n and bin(own.block % 2**64).count("1") > 4
    assert all((r.fp ^ own.fp) & own.block == 0 for r in df.collect())
