"""Duplicates and fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _surplus(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Rows beyond the first of each key; NULL keys are equal to each other.

    Counting per key combines on the map side, so a key that fills a third of the table
    travels as one row per task.
    """
    sizes = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("_rows"))
    return sizes.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias(out))


def row_hash(df: DataFrame) -> Column:
    """128-bit hash of a whole row."""
    return F.unhex(F.md5(F.concat_ws("|", *[_field(df, c) for c in df.columns])))


def row_hashes(df: DataFrame) -> DataFrame:
    """128-bit hash ``h`` of every row, so that whole rows need not be shuffled to be told apart."""
    return df.select(row_hash(df).alias("h"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier identical row."""
    return _surplus(row_hashes(df), ["h"], "duplicate_rows")


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier row's key."""
    return _surplus(df, keys, "duplicate_keys")


def _field(df: DataFrame, column: str) -> Column:
    """Text of one field.  Free text carries its length, so that it cannot run over a border."""
    text = F.col(f"`{column}`").cast("string")
    if isinstance(df.schema[column].dataType, T.StringType):
        text = F.concat(F.length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(text, F.lit("-"))


def table_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: row count and order-independent sums over row hashes.

    The four 32-bit words of every hash are summed apart; the sums are joined as text.  Each is
    taken in 16-bit halves, which as 64-bit numbers hold 10^14 rows.  Use integer, text or date
    columns; the text form of a double is engine-specific.
    """
    digest = F.md5(F.concat_ws("|", *[_field(df, c) for c in columns]))
    words = [F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"w{i}") for i in range(4)]
    hashed = df.select(digest.alias("h")).select(*words)
    total = lambda half: F.coalesce(F.sum(half), F.lit(0)).cast("decimal(38,0)")

    def summed(word: str) -> Column:
        high, low = F.shiftright(word, 16), F.col(word).bitwiseAND(F.lit(65535))
        return (total(high) * F.lit(65536) + total(low)).cast("decimal(38,0)").cast("string")

    return hashed.agg(F.count("*").alias("row_count"), F.concat_ws("-", *[summed(f"w{i}") for i in range(4)]).alias("fingerprint"))
