"""An id that repeats with different texts names several documents."""

import random

import corpus_pipeline
import numpy as np
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from sievework.llm import simhash, spans, suffix_dedup, superkmer

SF = "/root/testdata/sf0.001"


def unlike(seed, n=80):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_only_the_copy_goes(spark):
    a, b, c = unlike(1), unlike(2), unlike(3)
    rows = [(1, a), (7, a), (7, b), (7, c), (7, c), (8, c), (9, sentence(1, 90)), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id or 0, r.text) for r in simhash.one_of_each(df).collect()]
    assert sorted(got) == sorted([(1, a), (7, b), (7, c), (9, sentence(1, 90)), (0, a)])


def test_only_the_leaking_text_goes(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("size(split(text, ' ')) > 20").orderBy("item_id").first().text
    rows = [(7, unlike(1)), (7, unlike(2) + " " + item + " " + unlike(3)), (8, unlike(4)), (None, item)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id or 0, r.text) for r in corpus_pipeline.benchmark_leaks(spark, df, SF).collect()]
    assert sorted(got) == sorted([(7, rows[0][1]), (8, rows[2][1]), (0, item)])


@pytest.fixture(scope="module")
def alike_in_32_bits(spark):
    """Two unlike texts that a hash of 32 bits takes for one."""
    words = [F.concat(F.lit(f"w{k}x"), F.col("id").cast("string")) for k in range(16)]
    texts = spark.range(400_000).select(F.concat_ws(" ", *words).alias("text"))
    pairs = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).filter("size(t) > 1")
    a, b = pairs.first().t[:2]
    assert a != b
    return a, b


def test_texts_of_one_id_are_told_apart(spark, alike_in_32_bits):
    a, b = alike_in_32_bits
    df = spark.createDataFrame([(1, a), (7, a), (7, b), (7, b + " more")], "doc_id long, text string").repartition(2)
    removed = sorted((r.doc_id, r.n_words, r.n_removed) for r in superkmer.remove_repeats(df).collect())
    assert removed == [(1, 16, 0), (7, 16, 0), (7, 16, 16), (7, 17, 0)]
    removed = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect())
    assert removed == sorted([(1, len(a), 0), (7, len(a), len(a)), (7, len(b), 0), (7, len(b) + 5, 0)])
    assert sorted((r.doc_id, r.text) for r in simhash.one_of_each(df.filter("text not like '%more'")).collect()) == sorted([(1, a), (7, b)])


def test_leaks_of_texts_that_a_short_hash_takes_for_one(spark, alike_in_32_bits, tmp_path):
    a, b = alike_in_32_bits
    spark.createDataFrame([(0, a)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame([(7, a), (7, b)], "doc_id long, text string")
    assert [r.text for r in corpus_pipeline.benchmark_leaks(spark, df, str(tmp_path)).collect()] == [b]


def test_texts_of_one_id_spread(spark):
    rows = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    batch = spans.tagged(rows, "doc_id", "text").select("tag").toArrow()
    named = spans.tags(batch.column(0).combine_chunks())
    places = np.bincount(spans.dest_of(np.full(2000, 7), named, 50), minlength=50)
    assert places.min() > 15 and places.max() < 80


def test_tags_travel_only_where_they_tell_texts_apart(spark, monkeypatch):
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (3, None), (None, "x"), (4, None), (4, "")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, key int").repartition(2)
    tagged = spans.tagged(df, "doc_id", "text", ["key"])
    found = spans.identified(tagged)
    assert found.columns == tagged.columns and found.count() == len(rows)
    plain = {(r.key, r.text): bool(bytes(r.tag).strip(bytes(1))) for r in found.collect()}
    assert plain == {(1, "a"): False, (2, "b"): True, (2, "c"): True, (3, None): False, (None, "x"): True, (4, None): False, (4, ""): True}
    single = spans.identified(tagged.filter("key = 1 OR key IS NULL"))
    assert {(r.key, any(r.tag)) for r in single.collect()} == {(1, False), (None, True)}
    monkeypatch.setattr(spans, "SENT_DOCUMENTS", 1)
    assert all(any(r.tag) == (r.text is not None) for r in spans.identified(tagged).collect())
