"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, byte_cnn, chat, decontam, html_text, line_quality, prefix_trie, simhash, suffix_dedup, superkmer, token_counts, turn_repair, weak_labels
from sievework.scratch import written


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokens() -> list[bytes]:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    found = bpe.encode(table(spark, sf, "documents"), tokens(), public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of every document; the line model is fitted on the labelled ones."""
    docs = table(spark, sf, "documents")
    return line_quality.assess(docs, line_quality.fit_on_labels(docs, table(spark, sf, "labels")))


def op3_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    """What stays of every document once strings of 50 bytes seen in an earlier one are gone."""
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_weak_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Posterior, score and verdict of every document; no given label is read."""
    return weak_labels.classify(table(spark, sf, "documents"))


def op5_chat_masks(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one that quotes the template, formatted and read back, as digests."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    quoted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        formatted = chat.format_conversations(rows.unionByName(quoted), file.read())
    read = chat.read_back(formatted)
    turns = F.transform(F.arrays_zip("roles", "texts"), lambda t: F.concat(t["roles"], F.lit("\n"), t["texts"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("roles").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_byte_cnn(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; a quarter of the documents is never learned from."""
    docs = table(spark, sf, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    network = byte_cnn.train(docs, ~held_out)
    found = byte_cnn.identify(docs, network)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_super_kmers(spark: SparkSession, sf: str) -> DataFrame:
    """What stays of every document once windows of 13 words seen in an earlier one are gone."""
    found = superkmer.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_block_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_hamming_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a benchmark item, which, where and how similar."""
    return decontam.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return prefix_trie.rebuilt_trie(table(spark, sf, "conversations"))


def op12_token_transducer(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document by the piece model, and whether they exceed a context of 4096."""
    model = token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf, "documents"), model, limit=4096)


def op13_repair_path(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged conversations: faults, cheapest edits and what they give."""
    rows = turn_repair.damaged(table(spark, sf, "conversations"))
    planned = written(turn_repair.plans(rows), "repair-plans")
    return planned.join(turn_repair.repaired_digests(rows, planned), "conv").withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_line_rules": op2_line_rules,
    "op3_suffix_array": op3_suffix_array,
    "op4_weak_labels": op4_weak_labels,
    "op5_chat_masks": op5_chat_masks,
    "op6_byte_cnn": op6_byte_cnn,
    "op7_super_kmers": op7_super_kmers,
    "op8_simhash": op8_simhash,
    "op9_block_rules": op9_block_rules,
    "op10_hamming_windows": op10_hamming_windows,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_transducer": op12_token_transducer,
    "op13_repair_path": op13_repair_path,
}

#: A node's totals by all pairs of a node and one below it. The checksum is spelt out, bit by bit and byte by byte.
OP11_SQL = """
WITH checks AS (
  SELECT list(CASE WHEN b8 & 1 = 1 THEN xor(b8 >> 1, 3988292384) ELSE b8 >> 1 END ORDER BY i) AS crcs FROM (
  SELECT i, CASE WHEN b7 & 1 = 1 THEN xor(b7 >> 1, 3988292384) ELSE b7 >> 1 END AS b8 FROM (
  SELECT i, CASE WHEN b6 & 1 = 1 THEN xor(b6 >> 1, 3988292384) ELSE b6 >> 1 END AS b7 FROM (
  SELECT i, CASE WHEN b5 & 1 = 1 THEN xor(b5 >> 1, 3988292384) ELSE b5 >> 1 END AS b6 FROM (
  SELECT i, CASE WHEN b4 & 1 = 1 THEN xor(b4 >> 1, 3988292384) ELSE b4 >> 1 END AS b5 FROM (
  SELECT i, CASE WHEN b3 & 1 = 1 THEN xor(b3 >> 1, 3988292384) ELSE b3 >> 1 END AS b4 FROM (
  SELECT i, CASE WHEN b2 & 1 = 1 THEN xor(b2 >> 1, 3988292384) ELSE b2 >> 1 END AS b3 FROM (
  SELECT i, CASE WHEN b1 & 1 = 1 THEN xor(b1 >> 1, 3988292384) ELSE b1 >> 1 END AS b2 FROM (
  SELECT i, i AS b1 FROM range(256) AS t(i)))))))))
),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), checks
),
mixed AS (
  SELECT c.conv_id, 0 AS part, t.place, t.said FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.said FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h
),
whole AS (
  SELECT c.conv_id, coalesce(list(m.said ORDER BY part, place) FILTER (m.said IS NOT NULL), []) AS s
  FROM convs c LEFT JOIN mixed m USING (conv_id) GROUP BY c.conv_id
),
steps AS (SELECT conv_id, s, d FROM whole, range(0, 10000) AS r(d) WHERE d <= len(s)),
nodes AS (
  SELECT d, s[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ended
  FROM steps GROUP BY ALL
),
family AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT nodes.*, coalesce(family.n, 0) AS n_children, (n_convs - 1) * coalesce(strlen(nodes.p[nodes.d].t), 0) AS saved
  FROM nodes LEFT JOIN family USING (p, d)
),
below AS (
  SELECT p[1:a] AS p, a AS d, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM own, range(0, 10000) AS r(a) WHERE a <= d GROUP BY ALL
)
SELECT o.conv_id, o.d AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(o.ended) AS ends_sha256
FROM own o JOIN below b USING (p, d) LEFT JOIN nodes u ON u.d = o.d - 1 AND u.p = o.p[1:o.d - 1]
"""

#: The other methods have no SQL form; tests hold them against brute force.
ORACLES: dict[str, str] = {"op11_prefix_trie": OP11_SQL}
