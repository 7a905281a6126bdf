import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import quantiles
from sievework.operators.ordering import number_rows, running_total
from sievework.operators.quantiles import approximate_quantiles, exact_quantiles, joint_quantiles, order_statistics

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def samples():
    rng = random.Random(7)
    normal = [rng.gauss(0, 1) for _ in range(997)]
    return {
        "normal": normal,
        "ties": [float(rng.randrange(5)) for _ in range(1000)],
        "one value in three": [7.0 if i % 3 == 0 else v for i, v in enumerate(normal)],
        "far outliers": [*normal, 1e308, -1e308, 1e-308],
        "constant": [3.5] * 50,
        "single": [1.0],
        "two": [1.0, 2.0],
        "skewed": [rng.lognormvariate(0, 4) for _ in range(800)],
    }


@pytest.mark.parametrize("name", list(samples()))
@pytest.mark.parametrize("sortable", [1, 20, 10**6])
def test_exact_quantiles_at_any_limit(spark, name, sortable):
    numbers = samples()[name]
    df = spark.createDataFrame([(v,) for v in numbers] + [(None,), (float("nan"),)], "x double").repartition(3)
    got = exact_quantiles(df, "x", PROBABILITIES, sortable_rows=sortable)
    with np.errstate(over="ignore", invalid="ignore"):
        assert got == pytest.approx([float(np.quantile(numbers, p)) for p in PROBABILITIES], rel=1e-12)


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]
    assert order_statistics(df, "x", [0]) == [None]
    assert approximate_quantiles(df, "x", [0.5]) == [None]


def test_order_statistics(spark):
    df = spark.range(1000).select(((F.col("id") * 7) % 1000).alias("x"))
    assert order_statistics(df, "x", [0, 499, 999, 1000], sortable_rows=10) == [0.0, 499.0, 999.0, None]


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_001).select(F.col("id").alias("x"))
    assert approximate_quantiles(df, "x", [0.5])[0] == pytest.approx(5000, abs=2)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_positions_and_totals_do_not_depend_on_partitioning(spark, partitions):
    df = spark.range(500).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(50))).alias("k"), (F.col("id") % 7).alias("w")
    )
    expected = sorted((r["k"], r["id"], r["w"]) for r in df.collect())
    order = [F.col("k"), F.col("id")]
    numbered = number_rows(df.repartition(partitions), order, "n")
    assert sorted((r["k"], r["id"], r["n"]) for r in numbered.collect()) == [
        (k, i, n) for n, (k, i, _) in enumerate(expected, start=1)
    ]
    total, sums = 0, []
    for k, i, w in expected:
        total += w
        sums.append((k, i, total))
    summed = running_total(df.repartition(partitions), order, F.col("w"), "s")
    assert sorted((r["k"], r["id"], r["s"]) for r in summed.collect()) == sums


@pytest.mark.parametrize(
    "numbers",
    [
        [float("inf"), float("-inf"), *map(float, range(500)), float("inf")],
        [10.0**e for e in range(-300, 300)],
        [4.0] * 3000 + [1.0, 2.0, 9.0],
        [float("inf")] * 700 + [1.0],
    ],
)
def test_narrowing_ends_in_a_few_passes(spark, monkeypatch, numbers):
    passes = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    df = spark.createDataFrame([(v,) for v in numbers], "x double").repartition(3)
    ranks = [0, len(numbers) // 2, len(numbers) - 1]
    assert order_statistics(df, "x", ranks, sortable_rows=2) == [sorted(numbers)[r] for r in ranks]
    assert len(passes) <= 4


def test_infinite_neighbours(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "x double")
    assert exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == [1.0, 2.0, float("inf")]


def test_ten_columns_take_the_scans_of_one(spark, monkeypatch):
    """All columns are narrowed in the same passes; the answers are those of each column alone."""
    all_ = samples()
    rng = random.Random(3)
    columns = {f"c{i}": [rng.choice(list(all_["skewed"])) * (i + 1) if i % 3 else rng.choice(all_["ties"]) for _ in range(600)] for i in range(9)}
    columns["empty"] = [None] * 600
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(3)
    passes = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    got = joint_quantiles(df, list(columns), PROBABILITIES, sortable_rows=20)
    together, alone = len(passes), []
    for c, values in columns.items():
        passes.clear()
        assert got[c] == exact_quantiles(df, c, PROBABILITIES, sortable_rows=20)
        alone.append(len(passes))
        if values[0] is not None:
            assert got[c] == pytest.approx([float(np.quantile(values, p)) for p in PROBABILITIES], rel=1e-12)
    assert together <= max(alone) + 1 < sum(alone)
    assert got["empty"] == [None] * len(PROBABILITIES)
    assert joint_quantiles(df.limit(0), ["c0", "c1"], [0.5]) == {"c0": [None], "c1": [None]}
