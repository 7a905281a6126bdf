"""The tables behind exploratory plots."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.temporal import hour_of, month_of, weekday_of, year_of
from sievework.functions.text import as_column
from sievework.operators.profile import value_counts
from sievework.operators.quantiles import approximate_quantiles, joint_quantiles

_PARTS = {"hour": hour_of, "weekday": weekday_of, "month": month_of, "year": year_of}


def temporal_counts(df: DataFrame, ts: str, part: str) -> DataFrame:
    """Rows per hour, weekday (Monday = 0), month or year of a timestamp."""
    return value_counts(df.select(_PARTS[part](ts).alias(part)), part).withColumnRenamed("value", part)


def filter_top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """All rows of the ``k`` most frequent values.  The lookup side has ``k`` rows."""
    top = value_counts(df, column, k).select(F.col("value").alias(column))
    return df.join(F.broadcast(top), column, "left_semi").select(*df.columns)


def spatial_grid(df: DataFrame, lat: str, lon: str, category: str, cell: float) -> DataFrame:
    """Rows per grid cell and class, the density behind a scatter plot."""
    index = lambda c: F.floor(as_column(c) / F.lit(cell))
    return (
        df.where(as_column(lat).isNotNull() & as_column(lon).isNotNull())
        .groupBy(index(lat).alias("lat_cell"), index(lon).alias("lon_cell"), as_column(category))
        .agg(F.count("*").alias("row_count"))
    )


def _pearson(a: Column, b: Column) -> Column:
    """Correlation over rows that have both values; NULL when either does not vary."""
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation_matrix(df: DataFrame, columns: Sequence[str | Column], names: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, in one scan.

    Each unordered pair is computed once and reported both ways.
    """
    names = list(names or columns)
    numbers = {n: as_column(c).cast("double") for n, c in zip(names, columns)}
    cells = []
    for a in names:
        cells.append((a, a, _pearson(numbers[a], numbers[a])))
    for a, b in combinations(names, 2):
        cells.append((a, b, _pearson(numbers[a], numbers[b])))
    packed = df.agg(
        F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")) for a, b, r in cells]).alias("m")
    ).select(F.explode("m").alias("cell"))
    mirrored = F.when(
        F.col("cell.a") != F.col("cell.b"),
        F.array(
            F.struct(F.col("cell.a").alias("a"), F.col("cell.b").alias("b"), F.col("cell.r").alias("r")),
            F.struct(F.col("cell.b").alias("a"), F.col("cell.a").alias("b"), F.col("cell.r").alias("r")),
        ),
    ).otherwise(
        F.array(F.struct(F.col("cell.a").alias("a"), F.col("cell.b").alias("b"), F.col("cell.r").alias("r")))
    )
    return packed.select(F.inline(mirrored))


def box_stats(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Per column: quartiles, whiskers (outermost values within the fences), outlier count.

    The quartiles of all columns are fitted together; whiskers and outliers of all columns take one
    more scan.
    """
    shares = [0.25, 0.5, 0.75]
    quartiles = {c: approximate_quantiles(df, c, shares) for c in columns} if approx else joint_quantiles(df, columns, shares)
    boxes = []
    for c in columns:
        q1, median, q3 = quartiles[c]
        value = as_column(c).cast("double")
        if q1 is None:
            inside = F.lit(False)
        else:
            inside = value.between(F.lit(q1 - k * (q3 - q1)), F.lit(q3 + k * (q3 - q1)))
        number = lambda x: F.lit(x).cast("double")
        boxes.append(
            F.struct(
                F.lit(c).alias("column_name"),
                number(q1).alias("q1"),
                number(median).alias("median"),
                number(q3).alias("q3"),
                F.min(F.when(inside, value)).alias("whisker_low"),
                F.max(F.when(inside, value)).alias("whisker_high"),
                F.count_if(value.isNotNull() & ~F.isnan(value) & ~inside).alias("outliers"),
            )
        )
    return df.agg(F.array(*boxes).alias("boxes")).select(F.inline("boxes"))


def class_balance(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per class, and the ratio of the largest class to this one.

    Total and maximum come from a subquery over the class counts, not from a window over
    all classes, which would be one task.
    """
    counts = value_counts(df, column)
    overall = counts.agg(
        F.struct(F.sum("row_count").alias("total"), F.max("row_count").alias("largest"))
    ).scalar()
    rows = F.col("row_count")
    return counts.select(
        "value",
        rows,
        (rows / overall["total"]).alias("share"),
        (overall["largest"] / rows).alias("imbalance"),
    )
