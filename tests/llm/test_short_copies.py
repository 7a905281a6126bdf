"""Documents with fewer words than a benchmark item."""

import corpus_pipeline
from test_decontam import plain_leaks

from sievework.llm import decontam, queries


def test_whole_documents(spark, tmp_path):
    item = [f"w{i}" for i in range(54)]
    other = [f"v{i}" for i in range(15)]
    items = [(0, " ".join(item)), (1, " ".join(other)), (2, "x y " * 15), (3, "a b c")]
    docs = [(cut, " ".join(item[: 54 - cut])) for cut in range(14)]
    docs += [(20 + cut, " ".join(item[cut:])) for cut in range(14)]
    docs += [(40 + cut, " ".join(other[cut:])) for cut in range(5)]
    docs += [(50, " ".join(item[:20] + item[21:])), (51, " ".join(item[2:20] + ["new"] + item[21:-1])), (52, "x y " * 13), (53, "a b"), (54, ""), (55, " ".join(item) + " and more")]
    rows = [(i, t, "en", "s", len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expected = plain_leaks(docs, items)
    assert {1, 9, 40, 41, 50, 52} <= {i for i, *_ in expected}
    found = queries.op10_hamming_windows(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in found) == expected
    kept = corpus_pipeline.benchmark_leaks(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in docs} - {i for i, *_ in expected})
    alone = decontam.leaks(spark.createDataFrame(docs[1:2], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert [r.item_id for r in alone.collect()] == [0]
