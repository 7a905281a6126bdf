import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import encode, sampling, selection


def test_codes_are_dense_and_in_text_order(spark, rows):
    df = spark.createDataFrame([(10,), (2,), (2,), (0,), (None,)], "area int")
    text = F.col("area").cast("string")
    assert rows(encode.label_mapping(df, text)) == [("0", 0), ("10", 1), ("2", 2)]
    assert rows(encode.label_encode(df, text, "code")) == [(0, 0), (10, 1), (2, 2), (2, 2), (None, None)]
    assert rows(encode.label_encode(df, "area", "code")) == [(0, 0), (10, 2), (2, 1), (2, 1), (None, None)]


@pytest.mark.parametrize("n", [0, 1, 100, 500, 900])
def test_sample_has_exact_size_and_is_repeatable(spark, n):
    df = spark.range(500)
    expected = sorted(range(500), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())[:n]
    for partitions in (1, 9):
        got = sorted(r["id"] for r in sampling.fixed_sample(df.repartition(partitions), n, 7, "id").collect())
        assert got == sorted(expected)


def test_plugin_information(spark):
    data = [(i % 4, (i % 4) // 2 if i % 5 else 1, i) for i in range(1000)]
    df = spark.createDataFrame(data, "x int, y int, i int")
    joint, px, py = Counter((x, y) for x, y, _ in data), Counter(x for x, *_ in data), Counter(y for _, y, _ in data)
    expected = sum(c / 1000 * math.log(c * 1000 / (px[x] * py[y])) for (x, y), c in joint.items())
    got = {r["feature"]: r["mi"] for r in selection.mi_plugin(df.withColumn("one", F.lit(1)), ["x", "one"], "y").collect()}
    assert got["x"] == pytest.approx(expected, abs=1e-12)
    assert got["one"] == pytest.approx(0.0, abs=1e-12)


def brute_force_knn(x, y, keys, feature, k):
    """The estimator by all pairs, with the same repeatable noise."""
    std = np.std(x) or 1.0
    noise = np.array([int(hashlib.md5(f"{feature}:{key}".encode()).hexdigest()[:8], 16) / 2**32 - 0.5 for key in keys])
    x = x / std + 1e-10 * max(1.0, np.mean(np.abs(x)) / std) * noise
    sizes = Counter(y)
    keep = np.array([sizes[c] > 1 for c in y])
    x, y = x[keep], np.array(y)[keep]
    psi = lambda n: sum(1 / i for i in range(1, n)) - 0.5772156649015329
    total, terms = len(x), []
    for i in range(total):
        same = np.sort(np.abs(x[(y == y[i])] - x[i]))[1:]
        k_i = min(k, len(same))
        near = np.abs(x - x[i]) < same[k_i - 1] * (1 - 1e-12)
        terms.append(psi(k_i) - psi(len(same) + 1) - psi(int(near.sum())))
    return max(0.0, psi(total) + float(np.mean(terms)))


@pytest.mark.parametrize("block_rows", [5, 64, 100_000])
def test_neighbour_information_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(11)
    n = 300
    y = [int(v) for v in rng.integers(0, 3, n)]
    y[:2], y[2:4], y[4] = [7, 7], [8, 8], 9
    columns = {
        "shifted": rng.normal(size=n) + np.array(y) % 3,
        "free": rng.lognormal(size=n),
        "hours": rng.integers(0, 24, n).astype(float),
        "flag": rng.integers(0, 2, n).astype(float),
    }
    data = [(i, y[i], *[float(c[i]) for c in columns.values()]) for i in range(n)]
    df = spark.createDataFrame(data, "key int, y int, " + ", ".join(f"{c} double" for c in columns)).repartition(3)
    got = {
        r["feature"]: r["mi"]
        for r in selection.mi_knn(df, list(columns), "y", "key", block_rows=block_rows).collect()
    }
    for name, x in columns.items():
        assert got[name] == pytest.approx(brute_force_knn(x, y, range(n), name, 3), abs=1e-9), name


def test_selection_is_strict_and_keeps_candidate_order(spark):
    scores = spark.createDataFrame([("b", 0.1), ("a", 0.2), ("c", 0.005)], "feature string, mi double")
    assert selection.selected_names(scores, ["a", "b", "c"]) == ["a", "b"]


def test_keys_that_repeat_or_are_missing(spark):
    """Information does not depend on whether the key is unique; distinct values need no noise."""
    rng = np.random.default_rng(3)
    y = [int(v) for v in rng.integers(0, 2, 400)]
    x = rng.normal(size=400) + np.array(y)
    expected = brute_force_knn(x, y, range(400), "x", 3)
    for keys in (range(400), [i // 4 for i in range(400)], [None if i % 3 else i for i in range(400)]):
        df = spark.createDataFrame([(k, c, float(v)) for k, c, v in zip(keys, y, x)], "key int, y int, x double").repartition(3)
        assert selection.mi_knn(df, ["x"], "y", "key").first()["mi"] == pytest.approx(expected, abs=1e-6)


def test_samples_keep_rows_without_a_key(spark):
    df = spark.createDataFrame([(None if i % 2 else 1, i) for i in range(10)], "key int, v int").repartition(3)
    assert sampling.fixed_sample(df, 100, 1, "key").count() == 10
    taken = [sorted(r["v"] for r in sampling.fixed_sample(d, 7, 1, "key").collect()) for d in (df, df.repartition(5))]
    assert taken[0] == taken[1] and len(taken[0]) == 7
