"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Documents of a label that are taken before those of frequent labels fill the sample.
EACH_LABEL = 50


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id", text: str = "text", each: int = EACH_LABEL) -> DataFrame:
    """``key``, ``text``, ``label`` of at most ``rows`` labelled documents, chosen by a hash of the key.

    The first ``each`` keys of every label come before all others, so a rare label is in the sample
    however many rows there are.  A key with several labels has the smallest; of a key with
    several texts the one with the smallest hash counts, so the bound is on rows.  The chosen keys are at
    most ``rows``, so they are broadcast and the documents are not shuffled.  Rows with a null key
    or label are not labelled.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).filter("key IS NOT NULL AND label IS NOT NULL")
    known = known.withColumn("place", F.xxhash64(F.col("key").cast("string")))
    single = known.groupBy("key", "place").agg(F.min("label").alias("label"))
    # Only the first few of a label are ranked, and Spark cuts them down before the shuffle.
    rank = F.row_number().over(W.partitionBy("label").orderBy("place", "key"))
    first = single.withColumn("rank", rank).filter(F.col("rank") <= each).select("key", "place", "label", F.lit(0).alias("later"))
    others = single.orderBy("place", "key").limit(rows).select("key", "place", "label", F.lit(1).alias("later"))
    chosen = first.unionByName(others).groupBy("key", "place", "label").agg(F.min("later").alias("later")).orderBy("later", "place", "key").limit(rows)
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "key")
    one = found.groupBy("key", "place", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.orderBy("place", "key").select("key", "text", "label")
