"""Schema checks, null and distinct profiles, frequencies and the column catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import as_column
from sievework.scratch import written


def schema_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Every expected or present column with its status: ok, missing or extra.

    The input is the two lists of column names, not the rows.
    """
    spark = df.sparkSession
    present = spark.createDataFrame([(c,) for c in df.columns], "column_name string")
    wanted = spark.createDataFrame([(c,) for c in expected], "column_name string")
    marked = (
        present.withColumn("present", F.lit(1))
        .join(wanted.withColumn("wanted", F.lit(1)), "column_name", "full_outer")
    )
    status = (
        F.when(F.col("present").isNull(), F.lit("missing"))
        .when(F.col("wanted").isNull(), F.lit("extra"))
        .otherwise(F.lit("ok"))
    )
    return marked.select("column_name", status.alias("status"))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in expected if c not in present]


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint")
    )


def _one_row_per(pieces: dict[str, list[Column]], fields: Sequence[str]) -> Column:
    """Turn named groups of aggregates into an array of structs for ``inline``."""
    structs = [
        F.struct(F.lit(name).alias("column_name"), *[v.alias(f) for v, f in zip(values, fields)])
        for name, values in pieces.items()
    ]
    return F.array(*structs)


def null_summary(df: DataFrame) -> DataFrame:
    """NULL count and percent per column, for columns that have any.  One scan."""
    counts = {c: [F.count_if(as_column(c).isNull())] for c in df.columns}
    totals = df.agg(
        F.count("*").alias("total"), _one_row_per(counts, ["null_count"]).alias("columns")
    )
    return (
        totals.select("total", F.inline("columns"))
        .where(F.col("null_count") > 0)
        .select(
            "column_name",
            "null_count",
            F.round(F.try_divide(F.col("null_count") * F.lit(100.0), F.col("total")), 2).alias("null_pct"),
        )
    )


def distinct_count(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """One row: number of distinct non-null values."""
    counter = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(counter(as_column(column)).alias("distinct_count"))


def value_counts(df: DataFrame, column: str, k: int | None = None, sort: str | None = None) -> DataFrame:
    """Rows per non-null value.

    ``k`` makes it a top-k report.  ``sort`` puts the most frequent first (``count``, ties
    by value; the default of a report) or the values in order (``key``).
    """
    counts = (
        df.select(as_column(column).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("row_count"))
    )
    sort = sort or ("count" if k is not None else None)
    if sort is not None:
        order = {"count": [F.desc("row_count"), F.asc("value")], "key": [F.asc("value")]}[sort]
        counts = counts.orderBy(*order)
    return counts if k is None else counts.limit(k)


#: Cells that values are hashed into, by two hashes; candidates for each wanted value, and items the sketch tracks at least.
CELLS = 1 << 16
CANDIDATES_EACH = 4
TRACKED = 4_096


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The same as ``value_counts(df, column, k)``, for columns of very many different values.

    Nothing is grouped by value but a few.  A sketch names candidates and one scan counts them exactly; the
    k-th of them is a bound that no value below it can beat.  Another scan counts rows by two hashes of the
    value.  A cell whose rows, less those of its candidates, stay under the bound holds no other
    value that matters; where that is so for all cells of one hash, none is missed.  Values of which both
    cells are undecided are counted exactly as well.  What is shuffled grows with ``k`` and
    the cells, not with the number of values, unless values are so even that no bound tells them apart.
    """
    rows = df.select(as_column(column).alias("value")).where(F.col("value").isNotNull())
    wanted = CANDIDATES_EACH * k
    sketch = rows.selectExpr(f"approx_top_k(value, {wanted}, {max(TRACKED, 4 * wanted)}) AS found")
    candidates = written(sketch.select(F.explode("found.item").alias("value")).where("value IS NOT NULL").distinct(), "candidates")
    known = written(rows.join(F.broadcast(candidates), "value").groupBy("value").agg(F.count("*").alias("row_count")), "candidate-counts")
    best = known.orderBy(F.desc("row_count")).limit(k).agg(F.count("*").alias("n"), F.min("row_count").alias("least")).first()
    bound = best["least"] if best["n"] == k else 1

    def placed(of: DataFrame, rows_: Column) -> DataFrame:
        cells = [F.struct(F.lit(i).alias("hash"), F.pmod(F.xxhash64(F.lit(i), "value"), F.lit(CELLS)).cast("int").alias("cell")) for i in range(2)]
        return of.select(F.explode(F.array(*cells)).alias("c"), rows_.alias("n")).groupBy("c.hash", "c.cell").agg(F.sum("n").alias("n"))

    counted = placed(known, F.col("row_count")).withColumnRenamed("n", "counted")
    left = F.col("n") - F.coalesce("counted", F.lit(0))
    undecided = placed(rows, F.lit(1)).join(counted, ["hash", "cell"], "left").filter(left >= bound).select("hash", "cell")
    undecided = written(undecided, "undecided-cells")
    if undecided.select("hash").distinct().count() == 2:
        rest = rows.join(F.broadcast(candidates), "value", "left_anti")
        for i in range(2):
            # At most ``CELLS`` numbers.
            cells = undecided.filter(F.col("hash") == i).select("cell")
            rest = rest.withColumn("cell", F.pmod(F.xxhash64(F.lit(i), "value"), F.lit(CELLS)).cast("int")).join(F.broadcast(cells), "cell", "left_semi").drop("cell")
        known = known.unionByName(rest.groupBy("value").agg(F.count("*").alias("row_count")))
    return known.orderBy(F.desc("row_count"), F.asc("value")).limit(k)


def sample_values(df: DataFrame, column: str, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` non-null values of a column in the order of a unique key."""
    keys = [as_column(c) for c in order_by]
    return (
        df.where(as_column(column).isNotNull())
        .orderBy(*keys)
        .limit(n)
        .select(*keys, as_column(column).alias("value"))
    )


def _is_ranged(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def _range_of(column: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Smallest and largest value as doubles; booleans count as 0 and 1, text has none."""
    if not _is_ranged(kind):
        nothing = F.lit(None).cast("double")
        return nothing, nothing
    if isinstance(kind, T.BooleanType):
        column = column.cast("int")
    return F.min(column).cast("double"), F.max(column).cast("double")


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: NULL count, distinct count, type, and range if numeric or boolean.

    Exact distinct counts are one aggregation per column, each reading that column
    alone; together they read the table once.  (All of them in one aggregation would
    multiply every row by the number of columns before the shuffle.)  ``df`` should
    therefore be a table scan.  ``approx`` answers everything in a single scan without
    any large shuffle.
    """
    fields = ["null_count", "distinct_count", "inferred_type", "min_value", "max_value"]
    chosen = list(columns or df.columns)

    def pieces(name: str) -> list[Column]:
        column, kind = as_column(name), df.schema[name].dataType
        counter = F.approx_count_distinct if approx else F.count_distinct
        return [
            F.count_if(column.isNull()),
            counter(column),
            F.lit(kind.simpleString()),
            *_range_of(column, kind),
        ]

    if approx:
        packed = df.agg(_one_row_per({c: pieces(c) for c in chosen}, fields).alias("columns"))
        return packed.select(F.inline("columns"))
    profiles = [
        df.agg(*[p.alias(f) for p, f in zip(pieces(c), fields)]).select(
            F.lit(c).alias("column_name"), *fields
        )
        for c in chosen
    ]
    return reduce(DataFrame.unionByName, profiles)


#: Hand-written description of a column.
ANNOTATION_SCHEMA = (
    "column_name string, declared_type string, nullable boolean, zone string, role string, notes string, description string"
)


def column_catalog(profile: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotations with the measured profile; columns the data lacks keep the annotation only.

    Both sides have one row per column of one table.
    """
    return annotations.join(F.broadcast(profile), "column_name", "left")


def roles_summary(annotations: DataFrame) -> DataFrame:
    """Column names by role, one row per role (as many names as the table has columns)."""
    return annotations.groupBy("role").agg(
        F.count("*").alias("column_count"),
        F.array_join(F.sort_array(F.collect_list("column_name")), ",").alias("columns"),
    )


def drop_by_role(df: DataFrame, annotations: Sequence[tuple], role: str) -> DataFrame:
    """Leave out the columns whose annotation has the role, e.g. ``excluded``."""
    named = [row[0] for row in annotations if row[4] == role]
    return df.drop(*named)
