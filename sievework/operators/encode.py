"""Dense integer codes for categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import as_column
from sievework.operators.ordering import number_rows
from sievework.scratch import written


def label_mapping(df: DataFrame, column: Column | str) -> DataFrame:
    """(value, code) with codes 0..n-1 in value order, as a written table; NULL has no code.

    Cast the column to string to get text order ("10" before "2").  Values are numbered
    in parallel, so the number of classes is not limited by one task.
    """
    values = (
        df.select(as_column(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    )
    numbered = number_rows(values, [F.col("value")], "_position")
    return written(numbered.select("value", (F.col("_position") - 1).cast("int").alias("code")), "codes")


def label_encode(df: DataFrame, column: Column | str, out: str, mapping: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the code of the column's value.  ``mapping`` reuses an earlier fit.

    The map is a written table, so Spark knows its size and broadcasts it if it is small;
    otherwise both sides are shuffled and frequent values split over tasks.
    """
    mapping = label_mapping(df, column) if mapping is None else mapping
    codes = mapping.select(F.col("value").alias("_value"), F.col("code").alias(out))
    keyed = df.withColumn("_value", as_column(column))
    return keyed.join(codes, "_value", "left").select(*[as_column(c) for c in df.columns], out)
