"""Line labelling, weak labels and language."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import byte_cnn, line_quality, queries, weak_labels

SF = "/root/testdata/sf0.001"


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    times, twice = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), [0] * len(w)
    for i in range(len(w) - 4):
        if times[tuple(w[i : i + 5])] > 1:
            twice[i : i + 5] = [1] * 5
    failed = len(w) < 10 or 100 * sum(twice) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(twice), failed


def test_counts(edge_docs, edge_rows):
    model = line_quality.LineModel(line_quality.PLAIN_WEIGHTS, line_quality.PLAIN_TRANSITIONS)
    rows = line_quality.assess(edge_docs, model).collect()
    got = sorted(((r.doc_id or 0), *r[1:7]) for r in rows)
    assert got == sorted(((i or 0), *plain_counts(t)) for i, t in edge_rows)
    assert not any(r.kept for r in rows if r.base_failed)
    passed = line_quality.passing(edge_docs, model)
    assert passed.schema == edge_docs.schema
    assert sorted(r.doc_id or 0 for r in passed.collect()) == sorted(r.doc_id or 0 for r in rows if r.kept)


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(0)
    doc = np.repeat(np.arange(6), [1, 7, 3, 5, 2, 4])
    scores, transitions = rng.normal(size=(len(doc), 2)), rng.normal(size=(2, 2))
    got = line_quality.best_labels(scores, doc, transitions)
    for d in range(6):
        mine = scores[doc == d]
        total = lambda p: sum(mine[i, x] for i, x in enumerate(p)) + sum(transitions[a, b] for a, b in zip(p, p[1:]))
        assert tuple(got[doc == d]) == max(itertools.product((0, 1), repeat=len(mine)), key=total)
    assert len(line_quality.best_labels(np.zeros((0, 2)), np.zeros(0, int), transitions)) == 0


def test_likelihood_fit_follows_its_gradient():
    """Fitted weights part two kinds of lines, and label pairs that never occur score low."""
    good, bad = np.zeros((5, len(line_quality.FEATURES))), np.zeros((4, len(line_quality.FEATURES)))
    good[:, 0], bad[:, 0], bad[:, 2] = 1, 1, 1
    model = line_quality.fit([good, bad] * 10, np.array([1, 0] * 10))
    assert good[0] @ model.weights > 0 > bad[0] @ model.weights
    assert model.transitions[0, 1] < model.transitions[1, 1] and model.transitions[1, 0] < model.transitions[0, 0]


def test_labelled_documents_are_judged_right(spark):
    docs, labels = (queries.table(spark, SF.replace("0.001", "0.01"), t) for t in ("documents", "labels"))
    found = line_quality.assess(docs, line_quality.fit_on_labels(docs, labels)).join(labels, "doc_id").filter("NOT base_failed")
    right = found.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


def test_nothing_to_fit_on(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = line_quality.fit_on_labels(edge_docs, none)
    assert model.weights is line_quality.PLAIN_WEIGHTS
    assert line_quality.assess(no_docs, model).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert line_quality.fit_on_labels(edge_docs, odd).weights is line_quality.PLAIN_WEIGHTS


def test_estimated_accuracies():
    """Votes drawn with known accuracies: the estimate comes near, without labels."""
    rng = np.random.default_rng(3)
    n, k = 20_000, len(weak_labels.LABELLERS)
    good, accuracy = rng.random(n) < 0.8, np.linspace(0.75, 0.95, k)
    right = rng.random((n, k)) < accuracy
    votes = np.where(right, np.where(good[:, None], 1, 2), np.where(good[:, None], 2, 1)) * (rng.random((n, k)) < 0.9)
    patterns, counts = np.unique(votes @ 3 ** np.arange(k), return_counts=True)
    model = weak_labels.estimate(patterns, counts.astype(float))
    assert np.abs(model.accuracies()["accuracy"] - accuracy).max() < 0.05
    assert abs(model.good - 0.8) < 0.03


def test_repeated_windows():
    content, owner = np.array([1, 2, 3, 1, 2, 3, 1, 2], np.uint64), np.array([0, 0, 0, 0, 0, 0, 1, 1])
    assert weak_labels.repeated(content, owner, 2, 2).tolist() == [2, 0]
    assert weak_labels.repeated(content, owner, 3, 2).tolist() == [1, 0]


def test_weak_labels_on_held_out_labels(spark):
    sf = SF.replace("0.001", "0.01")
    found = queries.op4_weak_labels(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id")
    right = found.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.95


def test_weak_labels_on_odd_rows(edge_docs, edge_rows, no_docs):
    rows = weak_labels.classify(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    wordless = [r for r in rows if r.doc_id in (5, 6, 7)]
    assert len(wordless) == 3 and not any(r.kept for r in wordless)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    assert weak_labels.classify(no_docs).count() == 0


def test_network_gradients():
    network = byte_cnn.ByteNetwork(["a", "b", "c"])
    network.values = {k: v.astype(np.float64) for k, v in network.values.items()}
    rng = np.random.default_rng(1)
    windows, target, weight = rng.integers(0, 256, (7, byte_cnn.WINDOW)).astype(np.uint8), rng.integers(0, 3, 7), np.ones(7)
    network.values["shift"] += 0.3

    def loss():
        _, _, top = network._pooled(windows)
        z = np.maximum(top + network.values["shift"], 0) @ network.values["out"] + network.values["bias"]
        return -np.mean(z[np.arange(7), target] - np.log(np.exp(z).sum(1)))

    grads = network._gradients(windows, target, weight)
    for name in network.values:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        kept, h = network.values[name][at], 1e-6
        network.values[name][at] = kept + h
        up = loss()
        network.values[name][at] = kept - h
        down = loss()
        network.values[name][at] = kept
        assert abs((up - down) / (2 * h) - grads[name][at]) < 1e-5


def test_windows_cover_whole_texts():
    data = np.arange(1, 201, dtype=np.uint8)
    windows, doc, length = byte_cnn.windows_of(data, np.array([0, 0, 130, 194, 200]))
    assert doc.tolist() == [1, 1, 1, 2, 3] and length.tolist() == [64, 64, 2, 64, 6]
    assert np.concatenate([w[:n] for w, n in zip(windows, length)]).tolist() == data.tolist()


def test_held_out_languages(spark):
    sf = SF.replace("0.001", "0.01")
    found = queries.op6_byte_cnn(spark, sf).join(queries.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.93


def test_languages_of_odd_rows(spark, edge_docs, edge_rows, no_docs):
    network = byte_cnn.train(edge_docs, F.lit(True))
    rows = byte_cnn.identify(edge_docs, network).collect()
    assert len(rows) == len(edge_rows)
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (5, 6, 7, 8)} == {5: "und", 6: "und", 7: "und", 8: "en"}
    nothing = byte_cnn.train(no_docs, F.lit(True))
    assert {r.lang_pred for r in byte_cnn.identify(edge_docs, nothing).collect()} == {"und"}
    assert byte_cnn.identify(no_docs, network).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_give_one_stable_schema(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.count()
    conversations = queries.table(spark, SF, "conversations").select("conv_id").distinct().count()
    expected = {"op5_chat_masks": 1 + conversations, "op13_repair_path": conversations, "op9_block_rules": queries.table(spark, SF, "pages").count()}
    if name not in ("op10_hamming_windows", "op11_prefix_trie"):
        assert rows == expected.get(name, queries.table(spark, SF, "documents").count())


def test_samples_keep_their_bound(spark):
    """An id with very many texts, repeats of labelled keys, and a label that only a few rows have."""
    from sievework.llm.sample import labelled_sample

    many = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    others = spark.range(2, 3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), "id").alias("text"))
    docs = many.unionByName(others).unionByName(others.limit(100))
    labels = spark.range(1, 3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1000 == 7, "rare").otherwise("frequent").alias("label"))
    labels = labels.unionByName(labels).unionByName(spark.createDataFrame([(1, "frequent")] * 50 + [(None, "rare"), (5, None)], "doc_id long, label string"))
    found = [tuple(r) for r in labelled_sample(docs, labels, "label", 200).collect()]
    assert len(found) == 200 == len({k for k, _, _ in found})
    assert sum(label == "rare" for _, _, label in found) == 3
    assert found == [tuple(r) for r in labelled_sample(docs.repartition(7), labels.repartition(3), "label", 200).collect()]
    assert len(labelled_sample(docs, labels, "label", 100_000).collect()) == 2999


JUNK = ["### ||| $$$ %%% &&& *** ||| ### $$$ %%%", "| buy | now | *** | $$$ | ### | %%% |", "&&& ### click*** here$$$ free%%% win### now|||"]


@pytest.fixture(scope="module")
def line_model(spark):
    docs, labels = (queries.table(spark, SF.replace("0.001", "0.01"), t) for t in ("documents", "labels"))
    return line_quality.fit_on_labels(docs, labels)


def labels_of(model, lines):
    raw = "\n".join(lines).encode()
    found = line_quality.Lines(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    scores = np.zeros((len(found.doc), 2))
    scores[:, 1] = found.features @ model.weights
    return line_quality.best_labels(scores, found.doc, model.transitions).tolist(), line_quality.judged(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), model)[7][0]


@pytest.mark.parametrize("content,junk", [(9, 3), (3, 9), (6, 6)])
def test_lines_of_mixed_documents(line_model, content, junk):
    """Lines get labels of their own, runs of three or more the right ones: the share lies between 0 and 1."""
    good = [f"The river runs under the old bridge number {i} and past the green house by the water." for i in range(content)]
    bad = [JUNK[i % 3] + f" {i}" for i in range(junk)]
    half = content // 2
    orders = [(good + bad, [1] * content + [0] * junk), (bad + good, [0] * junk + [1] * content)]
    if half >= 3:
        orders.append((good[:half] + bad + good[half:], [1] * half + [0] * junk + [1] * (content - half)))
    for lines, known in orders:
        labels, share = labels_of(line_model, lines)
        assert labels == known
        chars = [sum(len(w) for w in line.split()) for line in lines]
        assert 0 < share < 1 and abs(share - sum(c for c, k in zip(chars, known) if k) / sum(chars)) < 0.15


def test_latent_labels_are_found():
    """Half of the lines of each document are of the other kind; the fit parts the kinds all the same."""
    rng = np.random.default_rng(1)
    features, labels = [], []
    for i in range(200):
        quality = i % 2
        kind = np.repeat([quality, quality, 1 - quality, quality], 3)
        x = np.zeros((12, len(line_quality.FEATURES)))
        x[:, 0], x[:, 2] = 1, np.where(kind == 0, 0.8, 0.0) + rng.normal(0, 0.05, 12)
        features.append(x)
        labels.append(quality)
    model = line_quality.fit(features, np.array(labels))
    scores = np.zeros((12, 2))
    scores[:, 1] = features[1] @ model.weights
    assert line_quality.best_labels(scores, np.zeros(12, int), model.transitions).tolist() == [1] * 6 + [0] * 3 + [1] * 3
