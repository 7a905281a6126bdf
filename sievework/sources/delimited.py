"""Header CSV with the quoting, bad-line and missing-value rules of a dataframe reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import DEFAULT_MISSING_TOKENS, null_if_missing
from sievework.sources.records import POSITION, has_quoted_line_ends, read_records
from sievework.sources.tables import ACCEPTED, LINE, POSITIONED, QUARANTINED, REASON, ROWS, land_raw

_LINE = LINE
_POSITION = POSITIONED
#: Why a row is not accepted.
TOO_LONG = "too many fields"
_QUOTED = r'"(?:[^"]|"")*"'


def _scan(spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str) -> DataFrame:
    """All-text scan that keeps the raw line of every row whose field count is off.

    The header of every file must name the columns in their order, else the query fails.

    Column pruning is off for this scan: with it the parser would only count the fields
    a query asks for, and the answer would depend on the query.
    """
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in columns] + [T.StructField(_LINE, T.StringType())]
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _LINE)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )


def _too_long(columns: Sequence[str], sep: str) -> Column:
    """True when the line holds more fields than there are columns.

    Only rows the parser has flagged carry their line; separators inside quotes are
    not counted.  The first column is named so that a bare count still reads the row.
    """
    bare = F.regexp_replace(F.col(_LINE), _QUOTED, "")
    separators = F.length(bare) - F.length(F.translate(bare, sep, ""))
    touches_row = F.coalesce(F.length(F.col(f"`{columns[0]}`")), F.lit(0)) >= 0
    return touches_row & F.coalesce(separators >= len(columns), F.lit(False))


def _parsed(spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str, multi_line: bool | None) -> DataFrame:
    """All columns as text, the raw line where the field count is off, and the position of the row."""
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    if multi_line is not True:
        found = has_quoted_line_ends(spark, path, sep)
        if found and multi_line is False:
            raise ValueError("a quoted field holds a line end or is never closed; read with multi_line")
        multi_line = found
    if not multi_line:
        place = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        position = F.struct(*(c.alias(n) for c, n in zip(place, POSITION)))
        return _scan(spark, path, columns, sep).withColumn(_POSITION, position)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _LINE]])
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "multiLine": "true"}
    records = read_records(spark, path, sep)
    rows = records.select(F.from_csv("record", schema.toDDL(), options).alias("r"), F.struct(*POSITION).alias(_POSITION))
    is_header = (F.col(f"{_POSITION}.block") == 0) & (F.col(f"{_POSITION}.line") == 0)
    names = F.concat_ws("\0", *(F.coalesce(F.col("r")[c], F.lit("")) for c in columns))
    complaint = F.raise_error(F.concat(F.lit("unlike header in "), F.col(f"{_POSITION}.file"))).cast("boolean")
    rows = rows.filter(F.when(~is_header, True).when(names == "\0".join(columns), False).otherwise(complaint))
    return rows.select(*(F.col("r")[c].alias(c) for c in [*columns, _LINE]), _POSITION)


def staged_rows(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    sep: str = ",",
    missing_tokens: Sequence[str] = DEFAULT_MISSING_TOKENS,
    multi_line: bool | None = None,
) -> DataFrame:
    """All rows of one parse: the columns, ``_reason`` and ``_line`` of a row that is not accepted, ``_position`` and ``_rows``.

    ``_rows`` says accepted or quarantined, ``_position`` (file, block, line) is the order of arrival.
    """
    rows = _parsed(spark, path, columns, sep, multi_line)
    bad = _too_long(columns, sep)
    texts = [null_if_missing(c, missing_tokens).alias(c) for c in columns]
    reason = F.when(F.col("_bad"), F.lit(TOO_LONG))
    return rows.withColumn("_bad", bad).select(*texts, reason.alias(REASON), F.when(F.col("_bad"), F.col(_LINE)).alias(_LINE), _POSITION, F.when(F.col("_bad"), QUARANTINED).otherwise(ACCEPTED).alias(ROWS))


def land_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    root: str,
    version: str,
    ingest_date: str,
    sep: str = ",",
    missing_tokens: Sequence[str] = DEFAULT_MISSING_TOKENS,
    multi_line: bool | None = None,
) -> str:
    """Land delimited text: accepted rows and quarantined lines from one parse, under one commit."""
    return land_raw(staged_rows(spark, path, columns, sep, missing_tokens, multi_line), root, version, ingest_date, [ROWS])


def _landed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    position = T.StructType([T.StructField(n, T.StringType() if n == "file" else T.LongType()) for n in POSITION])
    fields = [*(T.StructField(c, T.StringType()) for c in [*columns, REASON, _LINE]), T.StructField(_POSITION, position), T.StructField(ROWS, T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def landed_rows(spark: SparkSession, path: str, columns: Sequence[str], arrival: bool = False) -> DataFrame:
    """Accepted rows of a landed version; with ``arrival`` also ``_position``, which sorts as they arrived."""
    rows = _landed(spark, path, columns).filter(F.col(ROWS) == ACCEPTED)
    return rows.select(*(F.col(f"`{c}`") for c in columns), *([_POSITION] if arrival else []))


def quarantined_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block``, ``line``, ``reason`` and ``text`` of the lines of a landed version that were not accepted."""
    rows = _landed(spark, path, []).filter(F.col(ROWS) == QUARANTINED)
    return rows.select(f"{_POSITION}.*", F.col(REASON).alias("reason"), F.col(_LINE).alias("text"))


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    sep: str = ",",
    on_bad_lines: str = "warn",
    missing_tokens: Sequence[str] = DEFAULT_MISSING_TOKENS,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read delimited text with a header line; every column is a string.

    Short rows are padded with NULL.  Rows with too many fields follow
    ``on_bad_lines``: ``warn`` leaves them out (:func:`bad_line_count` says how many),
    ``error`` fails the query, ``keep`` cuts the surplus fields off.  Files are read by many
    tasks.  One scan finds out whether quoted fields hold line ends; ``multi_line=True`` takes
    that for granted, ``False`` refuses such files.  A quoted field that is never closed fails.
    """
    rows = _parsed(spark, path, columns, sep, multi_line)
    too_long = _too_long(columns, sep)
    if on_bad_lines == "warn":
        rows = rows.where(~too_long)
    elif on_bad_lines == "error":
        complaint = F.raise_error(F.concat(F.lit("too many fields: "), F.col(_LINE)))
        rows = rows.where(F.when(too_long, complaint.cast("boolean")).otherwise(F.lit(True)))
    elif on_bad_lines != "keep":
        raise ValueError("on_bad_lines is one of warn, error, keep")
    return rows.select(*[null_if_missing(c, missing_tokens).alias(c) for c in columns])


def bad_line_count(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",", multi_line: bool | None = None
) -> DataFrame:
    """One row: how many lines hold too many fields."""
    return _parsed(spark, path, columns, sep, multi_line).agg(F.count_if(_too_long(columns, sep)).alias("bad_lines"))


def header_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of the header line; only the first line is read."""
    return spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(path).columns
