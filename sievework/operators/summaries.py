"""Column summaries that merge: counts, range, and sketches of distinct values and quantiles.

A summary is a row per column.  It is made once for a landed version, stored beside it, and those of any
versions combine without reading their rows again.  Counts and ranges are exact; distinct counts have a
relative standard error of 0.8 %, quantiles a rank error of about 1 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import as_column

#: Sizes of the sketches: 2 ** 14 registers, 400 items a level.
REGISTERS_LOG2 = 14
ITEMS = 400
FIELDS = ["column_name", "row_count", "null_count", "low", "high", "distinct_sketch", "quantile_sketch"]


def _is_ranged(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def summarise(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The summary of a table, in one scan; only a row per column and task is shuffled."""
    entries = []
    for name in columns or df.columns:
        column, kind = as_column(name), df.schema[name].dataType
        number: Column = F.lit(None).cast("double")
        if _is_ranged(kind):
            number = column.cast("int").cast("double") if isinstance(kind, T.BooleanType) else column.cast("double")
            number = F.when(~F.isnan(number), number)
        sketch = F.call_function("kll_sketch_agg_double", number, F.lit(ITEMS)) if _is_ranged(kind) else F.lit(None).cast("binary")
        values = [
            F.lit(name),
            F.count("*"),
            F.count_if(column.isNull()),
            F.min(number),
            F.max(number),
            F.hll_sketch_agg(column.cast("string"), F.lit(REGISTERS_LOG2)),
            sketch,
        ]
        entries.append(F.struct(*[v.alias(f) for v, f in zip(values, FIELDS)]))
    return df.agg(F.array(*entries).alias("columns")).select(F.inline("columns"))


def merged(summaries: DataFrame) -> DataFrame:
    """The summary of all rows that the summaries stand for, again a row per column."""
    numbers = F.call_function("kll_merge_agg_double", F.col("quantile_sketch"))
    return summaries.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.when(F.max("low").isNotNull(), numbers).alias("quantile_sketch"),
    )


def estimates(summary: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Counts and range of a summary, its ``distinct_count`` and ``quantiles`` (NULL where a column has no numbers)."""
    shares = F.array(*[F.lit(float(p)) for p in probabilities])
    return summary.select(
        "column_name",
        "row_count",
        "null_count",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"),
        F.col("low").alias("min_value"),
        F.col("high").alias("max_value"),
        F.when(F.col("low").isNotNull(), F.call_function("kll_sketch_get_quantile_double", F.col("quantile_sketch"), shares)).alias("quantiles"),
    )


def save_summary(df: DataFrame, root: str, version: str, ingest_date: str) -> str:
    """Store the summary of a landed version below ``root``; the path."""
    path = f"{root.rstrip('/')}/version={version}/ingest_date={ingest_date}"
    summarise(df).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """The stored summaries, with ``version`` and ``ingest_date``; filter before ``merged`` to choose versions."""
    return spark.read.parquet(root)
