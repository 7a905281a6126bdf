"""Cleaning steps.  Each takes a table and returns a table; none runs a query except the
outlier filter, which has to know its fences."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions.casts import US_TIMESTAMP
from sievework.functions.casts import parse_timestamp as timestamp_of
from sievework.functions.casts import to_bool as bool_of
from sievework.functions.casts import to_double as double_of
from sievework.functions.casts import to_long as long_of
from sievework.functions.text import DEFAULT_MISSING_TOKENS, as_column, null_if_missing, standardize
from sievework.operators.lookup import lookup_join
from sievework.operators.quantiles import approximate_quantiles, exact_quantiles

UNKNOWN = "UNKNOWN"
OTHER = "OTHER"


@dataclass(frozen=True)
class Box:
    """Closed latitude / longitude rectangle."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of identical rows; copies are merged before the shuffle."""
    return df.distinct()


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in the order of ``order_by``; rows without a key share one key.

    ``order_by`` must tell apart any two different rows of a key.  The filter on
    ``row_number`` keeps one row per key and task before the shuffle, so a key that
    fills a third of the table does not reach one task whole.
    """
    if _present(df, keys) != list(keys):
        return df
    first = W.partitionBy(*[as_column(k) for k in keys]).orderBy(*[as_column(o) for o in order_by])
    return df.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).drop("_nth")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Leave out rows that miss any of the columns."""
    return df.where(~any_missing(columns))


def any_missing(columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | as_column(c).isNull()
    return missing


def fill_missing(df: DataFrame, columns: Sequence[str], value: str | int | float) -> DataFrame:
    """Replace NULL by ``value`` in those of the columns the table has."""
    return df.withColumns({c: F.coalesce(as_column(c), F.lit(value)) for c in _present(df, columns)})


def normalize_missing(
    df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = DEFAULT_MISSING_TOKENS
) -> DataFrame:
    """NULL where the text of a column is one of the missing-value tokens."""
    return df.withColumns({c: null_if_missing(c, tokens) for c in _present(df, columns)})


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many values :func:`fill_missing` would fill, per column."""
    return df.agg(*[F.count_if(as_column(c).isNull()).alias(c) for c in _present(df, columns)])


def parse_ts(df: DataFrame, column: str, fmt: str = US_TIMESTAMP, on_error: str = "drop") -> DataFrame:
    """Text to zone-less timestamp; unreadable text drops the row or becomes NULL."""
    if on_error not in ("drop", "null"):
        raise ValueError("on_error is drop or null")
    parsed = df.withColumn(column, timestamp_of(column, fmt))
    return parsed.where(as_column(column).isNotNull()) if on_error == "drop" else parsed


def to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numbers from text, unreadable text becomes NULL."""
    return df.withColumns({c: double_of(c) for c in _present(df, columns)})


def to_int(df: DataFrame, columns: Sequence[str], default: int | None = 0) -> DataFrame:
    """Whole numbers from text, fraction cut off, unreadable text becomes ``default``."""
    return df.withColumns({c: long_of(c, default) for c in _present(df, columns)})


def to_bool(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """TRUE / FALSE from text, anything else becomes NULL."""
    return df.withColumns({c: bool_of(c) for c in _present(df, columns)})


def standardize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip whitespace and upper-case."""
    return df.withColumns({c: standardize(c) for c in _present(df, columns)})


def in_box(lat: str, lon: str, box: Box) -> Column:
    """Both coordinates inside the closed box; NULL (not kept) when one is missing."""
    return as_column(lat).between(box.lat_min, box.lat_max) & as_column(lon).between(
        box.lon_min, box.lon_max
    )


def bbox_filter(df: DataFrame, lat: str, lon: str, box: Box) -> DataFrame:
    return df.where(in_box(lat, lon, box))


def in_time_range(column: str, first: dt.date, as_of: dt.date) -> Column:
    """From the start of ``first`` to the very start of ``as_of``, both inclusive."""
    bounds = [F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz") for day in (first, as_of)]
    return as_column(column).between(*bounds)


def time_range_filter(df: DataFrame, column: str, first: dt.date, as_of: dt.date) -> DataFrame:
    return df.where(in_time_range(column, first, as_of))


def rare_categories(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Values with fewer than ``threshold`` rows, and their counts."""
    return (
        df.where(as_column(column).isNotNull())
        .groupBy(as_column(column).alias("value"))
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") < threshold)
    )


def merge_rare(df: DataFrame, column: str, threshold: int, other: str = OTHER) -> DataFrame:
    """Replace rare values by ``other``.

    ``df`` is read twice: once to count, once to replace.
    """
    rare = rare_categories(df, column, threshold).select(
        F.col("value").alias(column), F.lit(True).alias("_rare")
    )
    marked = lookup_join(df, rare, column, "left")
    return marked.withColumn(
        column, F.when(F.col("_rare"), F.lit(other)).otherwise(as_column(column))
    ).select(*df.columns)


@dataclass(frozen=True)
class Fence:
    """Accepted range of one column and what it was derived from."""

    column: str
    q1: float | None
    q3: float | None
    low: float | None
    high: float | None

    def keeps(self) -> Column:
        """True for values within the fences; a missing value is NULL, so not kept."""
        if self.low is None or self.high is None:
            return F.lit(False)
        return as_column(self.column).between(F.lit(self.low), F.lit(self.high))


def fit_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False) -> list[Fence]:
    """Interquartile fences, column after column: each sees only rows the earlier ones kept.

    Two numbers per column reach the driver, so the filter that follows is a plain range
    test, which can be pushed down to the scan.
    """
    quantiles = approximate_quantiles if approx else exact_quantiles
    fences: list[Fence] = []
    for column in columns:
        q1, q3 = quantiles(df, column, [0.25, 0.75])
        if q1 is None or q3 is None:
            fence = Fence(column, None, None, None, None)
        else:
            reach = k * (q3 - q1)
            fence = Fence(column, q1, q3, q1 - reach, q3 + reach)
        fences.append(fence)
        df = df.where(fence.keeps())
    return fences


def within_fences(fences: Sequence[Fence]) -> Column:
    kept = F.lit(True)
    for fence in fences:
        kept = kept & fence.keeps()
    return kept


def iqr_filter(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Keep rows inside the sequential interquartile fences (bounds included)."""
    return df.where(within_fences(fit_fences(df, columns, k, approx)))


def iqr_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Per column: quartiles, fences and how many rows it removes.  One scan after the fit."""
    fences = fit_fences(df, columns, k, approx)
    rows, reached = [], F.lit(True)
    for step, fence in enumerate(fences, start=1):
        removed = F.count_if(reached & ~F.coalesce(fence.keeps(), F.lit(False)))
        number = lambda x: F.lit(x).cast("double")
        spread = None if fence.q1 is None else fence.q3 - fence.q1
        rows.append(
            F.struct(
                F.lit(step).alias("step"),
                F.lit(fence.column).alias("column_name"),
                number(fence.q1).alias("q1"),
                number(fence.q3).alias("q3"),
                number(spread).alias("iqr"),
                number(fence.low).alias("low"),
                number(fence.high).alias("high"),
                removed.alias("removed"),
            )
        )
        reached = reached & F.coalesce(fence.keeps(), F.lit(False))
    return df.agg(F.array(*rows).alias("fences")).select(F.inline("fences"))


class QualityError(ValueError):
    """A strict quality check found missing critical values."""


def quality_summary(
    df: DataFrame,
    critical: Sequence[str],
    ranges: Sequence[str],
    category: str,
    flag: str,
    strict: bool = False,
) -> DataFrame:
    """One row: rows, critical NULLs, value ranges, number of classes, rate of a flag.

    ``strict`` runs the check and raises if a critical value is missing.
    """
    nulls = sum((F.count_if(as_column(c).isNull()) for c in critical), F.lit(0))
    bounds = []
    for c in ranges:
        bounds += [F.min(as_column(c)).alias(f"{c}_min"), F.max(as_column(c)).alias(f"{c}_max")]
    summary = df.agg(
        F.count("*").alias("row_count"),
        nulls.cast("bigint").alias("critical_nulls"),
        *bounds,
        F.count_distinct(as_column(category)).alias("class_count"),
        F.avg(as_column(flag).cast("int")).alias(f"{flag}_rate"),
    )
    if strict:
        found = summary.first()["critical_nulls"]
        if found:
            raise QualityError(f"{found} missing values in {list(critical)}")
    return summary
