"""Positions and running totals over a whole table, computed in parallel.

A window without ``PARTITION BY`` moves every row into one task.  Here the rows are
range-partitioned on the sort keys, the slices are written once (so that the slice a
row belongs to can never change between two reads), each slice is summed, and the few
slice totals become starting offsets for a window inside each slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.scratch import written

_SLICE = "_slice"
_START = "_start"
_PLACE = "_place"


def _starts(totals: DataFrame) -> DataFrame:
    """Total of all slices before each; one row per slice, so at most spark.sql.shuffle.partitions rows."""
    before = W.orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(_SLICE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias(_START))


def running_total(df: DataFrame, order_by: Sequence[Column], weight: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over this row and all rows sorted before it.

    ``order_by`` must be a unique key, which also keeps a frequent leading value from
    filling one slice.
    """
    sliced = written(
        df.withColumn("_weight", weight)
        .repartitionByRange(*order_by)
        .withColumn(_SLICE, F.spark_partition_id()),
        "slices",
    )
    starts = _starts(sliced.groupBy(_SLICE).agg(F.sum("_weight").alias("_total")))
    within = W.partitionBy(_SLICE).orderBy(*order_by).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        sliced.join(F.broadcast(starts), _SLICE)
        .withColumn(out, F.col(_START) + F.sum("_weight").over(within))
        .drop(_SLICE, _START, "_weight")
    )


def number_rows(df: DataFrame, order_by: Sequence[Column], out: str) -> DataFrame:
    """Add ``out``: the 1-based position of the row in the order of a unique key.

    The slices are sorted before they are written, so a row's place in its slice is the low part
    of the id that Spark gives it there: one shuffle, and no window.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    sliced = written(ranged.withColumn(_SLICE, F.spark_partition_id()).withColumn(_PLACE, place), "slices")
    starts = _starts(sliced.groupBy(_SLICE).agg(F.count("*").alias("_total")))
    numbered = sliced.join(F.broadcast(starts), _SLICE).withColumn(out, F.col(_START) + F.col(_PLACE) + 1)
    return numbered.drop(_SLICE, _START, _PLACE)
