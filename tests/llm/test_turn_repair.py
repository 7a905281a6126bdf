import hashlib
import re
import zlib
from itertools import combinations, product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import turn_repair as tr

SPACES = " \t\n\x0b\x0c\r"


def plain_codes(rows):
    """Faults and initials of (role, text) in order."""
    codes, seen = [], set()
    for role, text in rows:
        body = text.strip(SPACES)
        fault = tr.BLANK if not body else tr.DUPLICATE if (role, text) in seen else tr.TRUNCATED if body[-1] not in ".!?" else tr.FINE
        seen.add((role, text))
        codes.append((fault, role[:1]))
    return codes


def plain_repair(rows):
    """The best of all edit sequences, tried one by one."""
    codes, n, best = plain_codes(rows), len(rows), None
    for inserts in range(n + 3):
        for at in combinations(range(n + inserts), inserts):
            for letters in product("DKR", repeat=n):
                for written in product("ua", repeat=inserts):
                    rest, new = iter(zip(codes, letters, rows)), iter(written)
                    cost, audit, out = 0, "", []
                    for place in range(n + inserts):
                        if place in at:
                            role = next(new)
                            audit, cost, out = audit + "I", cost + 2, [*out, [role]]
                            continue
                        (fault, initial), letter, row = next(rest)
                        audit += letter
                        if letter == "D":
                            cost += 3
                            continue
                        if fault in (tr.BLANK, tr.DUPLICATE):
                            break
                        cost += (2 if letter == "R" else 0) + (fault == tr.TRUNCATED)
                        out.append(["u", "a"] if letter == "R" else [initial or "?"])
                    else:
                        if (best is None or (cost, audit) < best) and any(re.fullmatch("(s?(ua)+)?", "".join(w)) for w in product(*out)):
                            best = cost, audit
    return best


ROWS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "s"]), st.sampled_from(["Yes.", "no", " ", "Why?", "x \t"])), max_size=3)


@settings(deadline=None, max_examples=120)
@given(ROWS)
def test_least_edits_are_the_best_of_all(rows):
    codes = bytes(fault * 4 + max("-sua".find(initial) if initial else 0, 0) for fault, initial in plain_codes(rows))
    cost, audit = tr.least_edits(codes)
    assert (cost, audit) == plain_repair(rows)
    out = list(tr.edited(rows, audit))
    assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in out))


def test_many_rows_go_through():
    user, assistant = tr.FINE * 4 + 2, tr.FINE * 4 + 3
    assert tr.least_edits(bytes([user, assistant] * 1500)) == (0, "K" * 3000)
    assert tr.least_edits(bytes([user] * 800))[0] == 2 * 400


def plain_damage(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", hashlib.md5((r[2] or " ").encode()).hexdigest()))
    out = []
    for turn, role, text in rows:
        what = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if what:
            text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
            out += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return out


def plain_result(conv, rows):
    rows = plain_damage(conv, rows)
    turns = {t for t, _, _ in rows if t is not None}
    codes = plain_codes([r[1:] for r in rows])
    initials = [i for _, i in codes]
    cost, audit = tr.least_edits(bytes(f * 4 + max("-sua".find(i) if i else 0, 0) for f, i in codes))
    out = "\n".join(f"{r}:{t}" for r, t in tr.edited([r[1:] for r in rows], audit))
    counts = [sum(f == k for f, _ in codes) for k in (tr.BLANK, tr.DUPLICATE, tr.TRUNCATED)]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(out.encode()).hexdigest())


@pytest.fixture(scope="module")
def hard_rows():
    rows = [(c, t, ("user", "assistant", "system")[(c + t) % 3], f"Said {c % 3} {t // 2}{'.!?,'[t % 4]}") for c in range(1, 60) for t in range(c % 9)]
    rows += [(100, None, "user", "A."), (100, None, None, None), (100, 3, "assistant", None), (100, 3, "assistant", "B."), (100, 9, "user", "")]
    rows += [(101, 0, "user", "Same."), (101, 0, "user", "Same."), (101, 0, "user", "Same.")]
    rows += [(102, t, "user" if t % 2 else "assistant", "Long. " * 3000 + str(t)) for t in range(40)]
    rows += [(-7, 0, "user", " "), (-7, 1, "", "\x00"), (None, 0, "user", "No conversation.")]
    return rows


def frame(spark, rows):
    more = [(*r, 1, "x", "y") for r in rows]
    return spark.createDataFrame(more, "conv_id long, turn long, role string, text string, kind int, audit string, conv string").repartition(3)


def test_rows(spark, hard_rows):
    rows = tr.damaged(frame(spark, hard_rows))
    planned, out = tr.repair(rows)
    found = {tuple(r) for r in planned.join(tr.repaired_digests(rows, planned), "conv").collect()}
    convs = {r[0] for r in hard_rows if r[0] is not None}
    assert found == {plain_result(c, [r[1:] for r in hard_rows if r[0] == c]) for c in convs}
    texts = {}
    for r in out.orderBy("conv", "place").collect():
        texts.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()}.items() <= {r[0]: r[8] for r in found}.items()


def test_undamaged_and_empty(spark, hard_rows):
    good = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?")]
    planned, out = tr.repair(tr.undamaged(frame(spark, good)))
    assert [(r.cost, r.audit) for r in planned.collect()] == [(0, "KK")]
    assert [tuple(r) for r in out.orderBy("place").collect()] == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?")]
    planned, out = tr.repair(tr.damaged(frame(spark, good).limit(0)))
    assert planned.count() == out.count() == 0


def test_query(spark):
    from sievework.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    found = queries.op13_repair_path(spark, sf)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {tuple(r) for r in found.collect()} == {plain_result(c, r) for c, r in rows.items()}
