"""Repeatable samples of an exact size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import as_column

#: Hash digits per histogram; 16 ** 4 possible heads bound its size.
_DIGITS = 4


def sample_hash(key: Column | str, seed: int) -> Column:
    """Hash that puts the rows in a random but repeatable order; rows without a key share one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(as_column(key).cast("string"), F.lit(""))))


def _cut(df: DataFrame, digits: Column, wanted: Column) -> Column:
    """Smallest head at which so many rows are reached, and the rows before it."""
    heads = df.groupBy(digits.alias("head")).agg(F.count("*").alias("rows"))
    upto = W.orderBy("head").rowsBetween(W.unboundedPreceding, W.currentRow)
    reached = heads.withColumn("through", F.sum("rows").over(upto)).where(F.col("through") >= wanted)
    found = F.struct("head", (F.col("through") - F.col("rows")).alias("before"))
    return reached.agg(F.min(found)).scalar()


def _ordered_columns(df: DataFrame) -> list[Column]:
    unordered = (T.MapType, T.VariantType)
    return [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, unordered)]


def fixed_sample(df: DataFrame, n: int, seed: int, key: Column | str) -> DataFrame:
    """``min(n, rows)`` rows without replacement, always the same ones for a seed.

    The sample is the ``n`` smallest hashes of the key, ties by key and then by all other
    columns that have an order.  A histogram over the first
    hash digits finds where the n-th lies, a second one refines that place, and only the
    rows up to it, little more than ``n``, are sorted in the end.
    """
    hashed = sample_hash(key, seed)
    first = _cut(df, F.substring(hashed, 1, _DIGITS), F.lit(n))
    there = df.where(F.substring(hashed, 1, _DIGITS) == first["head"])
    second = _cut(there, F.substring(hashed, _DIGITS + 1, _DIGITS), F.lit(n) - first["before"])
    # "g" sorts after every hash: fewer than n rows, so all are taken.
    cut = F.coalesce(F.concat(first["head"], second["head"]), F.lit("g"))
    return (
        df.withColumn("_hash", hashed)
        .where(F.substring("_hash", 1, 2 * _DIGITS) <= cut)
        .orderBy("_hash", as_column(key), *_ordered_columns(df))
        .limit(n)
        .drop("_hash")
    )
