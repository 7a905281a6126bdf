import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from sievework.llm import prefix_trie as pt
from sievework.llm import queries


def plain_trie(sequences):
    """Rows of the trie of conversations {id: [(role, text), ...]}, node by node."""
    members, out = defaultdict(list), set()
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = {node: [m for m in members if len(m) == len(node) + 1 and m[:-1] == node] for node in members}

    def below(node):
        found, left = [], [node]
        while left:
            found.append(left.pop())
            left += children[found[-1]]
        return found

    for node, convs in members.items():
        ended = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(node))))
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below(node) if n)
        leaves = sum(not children[n] for n in below(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(convs), len(node), parent, len(convs), len(children[node]), leaves, saved, hashlib.sha256(ended.encode()).hexdigest()))
    return out


def plain_sequences(rows):
    found = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            found[conv].append((role or "", text or ""))
    return dict(found)


def plain_rebuilt(sequences):
    out = {}
    for conv, turns in sequences.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = sequences.get(conv - conv % 5, [])[:h] + turns[h:]
    return out


@pytest.fixture(scope="module")
def hard_rows():
    """Long and short conversations, copies, ties, repeats, nulls, absent bases, a common first turn."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{'Hello' if t == 0 else f'word {c % 3} {t // 3}'} é") for c in range(0, 70) for t in range(c % 12)]
    rows += [(200, t, "user", f"long {t}") for t in range(140)]
    rows += [(201, t, "user", f"long {t if t < 100 else -t}") for t in range(130)]
    rows += [(300, None, "user", "first"), (300, 0, "b", "x"), (300, 0, "a", "y"), (300, 0, "a", "y"), (300, 1, None, None), (300, 2, "", "")]
    rows += [(301, 0, "user", "only one"), (None, 0, "user", "none"), (None, None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], "conv_id long, turn long, role string, text string, depth int, name string, conv binary").repartition(5)


def test_rows(spark, hard_rows):
    plain = plain_sequences(hard_rows)
    assert {tuple(r) for r in pt.conversation_trie(frame(spark, hard_rows)).collect()} == plain_trie(plain)
    found = pt.rebuilt_trie(frame(spark, hard_rows)).collect()
    assert len(found) == len({tuple(r) for r in found}) and {tuple(r) for r in found} == plain_trie(plain_rebuilt(plain))


def test_only_a_root_and_no_rows(spark):
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    found = pt.rebuilt_trie(frame(spark, [(alone, 0, "user", "gone")])).collect()
    assert [tuple(r) for r in found] == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    assert pt.rebuilt_trie(frame(spark, [(1, 0, "a", "b")]).limit(0)).count() == 0


def test_many_conversations_end_at_one_node(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(3000) for t in range(2)]
    found = {r.depth: r for r in pt.conversation_trie(frame(spark, rows)).collect()}
    assert len(found) == 3 and found[2].n_convs == 3000 and found[0].saved_tokens == 2 * 2999 * 6
    assert found[2].ends_sha256 == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert found[1].ends_sha256 == pt.EMPTY_SHA


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_trie(plain_rebuilt(plain_sequences(rows)))
    found = queries.op11_prefix_trie(spark, sf)
    names = found.columns
    assert {tuple(r) for r in found.collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert set(con.sql(f"SELECT {', '.join(names)} FROM ({queries.OP11_SQL})").fetchall()) == want
