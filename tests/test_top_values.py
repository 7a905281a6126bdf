"""Top values by candidates and hashed cells against counting every value."""

import random

import pytest

from sievework.operators import profile


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string" if any(isinstance(v, str) for v in values) else "x long").repartition(3)


def cases():
    rng = random.Random(6)
    return {
        "skewed": [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)],
        "even": [i % 700 for i in range(2100)],
        "all different": list(range(900)),
        "ties at the end": [i // 3 for i in range(300)] + [7] * 5 + [9] * 5 + [None] * 20,
        "few": ["a", "a", "b", None],
        "one": [5] * 10,
    }


@pytest.mark.parametrize("name", list(cases()))
@pytest.mark.parametrize("cells", [8, 1 << 16])
def test_against_counting_all(spark, monkeypatch, name, cells):
    monkeypatch.setattr(profile, "CELLS", cells)
    monkeypatch.setattr(profile, "TRACKED", 32)
    df = frame(spark, cases()[name])
    assert profile.top_values(df, "x", 6).collect() == profile.value_counts(df, "x", 6).collect()


def test_nothing_to_count(spark):
    df = frame(spark, [1]).limit(0)
    assert profile.top_values(df, "x", 3).count() == 0


def test_a_skewed_column_is_never_grouped_by_value(spark, monkeypatch, capsys):
    """Ten frequent values among 20,000 single ones: the cells prove that no other one is missed."""
    df = spark.range(20_000).selectExpr("id AS x").unionByName(spark.range(3000).selectExpr("id % 10 AS x"))
    got = profile.top_values(df, "x", 10)
    got.explain()
    # The answer comes from the counted candidates alone.
    assert "Union" not in capsys.readouterr().out
    assert [tuple(r) for r in got.collect()] == [(i, 301) for i in range(10)]
