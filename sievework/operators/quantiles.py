"""Exact quantiles without collecting a column anywhere.

``percentile`` keeps every distinct value in the memory of one task.  Instead, the rows
that can hold a wanted rank are narrowed down: a mergeable sketch gives values that cut
them into cells of about equally many rows, the cells are counted exactly, the one that
holds the rank is kept with its true minimum and maximum, and so on until few enough rows
are left to sort.  A cell is a cut value itself or lies strictly between two, so every pass
shrinks every range, whatever the values (infinities are ordinary ones), and keeps a fixed
share of the *rows*: 10^12 rows need about three passes of two narrow scans.  A table
below the limit needs none.  The driver sees a handful of numbers per pass.

Several columns are narrowed together: a row gives one value for each column inside the task, and
the ranges of all columns are met in the same two scans of a pass, however many columns there are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows one task may sort to read off the wanted ranks; no effect on the answer.
SORTABLE_ROWS = 1_000_000
#: Cut values per range and pass (of many columns together fewer, so that the tests stay small), and the
#: accuracy of the sketch they come from.
CUTS = 256
LEAST_CUTS = 16
SKETCH_ACCURACY = 4_096


@dataclass(frozen=True)
class _Bracket:
    """Closed value range of a column known to hold a rank: its bounds, rows below it, rows in it."""

    column: int
    low: float
    high: float
    below: int
    rows: int

    def settled(self, sortable: int) -> bool:
        return self.rows <= sortable or self.low == self.high

    def holds(self, value: Column) -> Column:
        return value.between(F.lit(self.low), F.lit(self.high))


#: A wanted rank: number of the column, 0-based rank.
_Rank = tuple[int, int]


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``c`` (number of the column) and ``v`` of every value that is a number."""
    each = [F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)]
    return df.select(F.inline(F.array(*each))).where(F.col("v").isNotNull() & ~F.isnan("v"))


def _by_column(tests: Mapping[int, Column]) -> Column:
    """The expression of the value's own column."""
    chosen = F.lit(None).cast("int")
    for c, test in tests.items():
        chosen = F.when(F.col("c") == c, test).otherwise(chosen)
    return chosen


def _numbered(brackets: Sequence[_Bracket]) -> Column:
    """Number of the bracket that holds the value; two brackets of a column share no value or are the same."""
    tests: dict[int, Column] = {}
    for i, b in enumerate(brackets):
        tests[b.column] = F.when(b.holds(F.col("v")), F.lit(i)).otherwise(tests.get(b.column, F.lit(None).cast("int")))
    return _by_column(tests)


def _cell(cuts: Sequence[float], start: int = 0) -> Column:
    """Twice the number of cuts below the value, plus one if the value is a cut: a balanced tree of tests."""
    if not cuts:
        return F.lit(2 * start)
    middle, v = len(cuts) // 2, F.col("v")
    low, high = _cell(cuts[:middle], start), _cell(cuts[middle + 1 :], start + middle + 1)
    at = F.lit(2 * (start + middle) + 1)
    return F.when(v < F.lit(cuts[middle]), low).when(v == F.lit(cuts[middle]), at).otherwise(high)


def _narrow(values: DataFrame, brackets: dict[_Rank, _Bracket], sortable: int) -> dict[_Rank, _Bracket]:
    """One pass: replace every unsettled bracket by the cell that holds its rank."""
    open_brackets = sorted({b for b in brackets.values() if not b.settled(sortable)}, key=lambda b: (b.column, b.low))
    held = values.select("v", _numbered(open_brackets).alias("bracket")).where(F.col("bracket").isNotNull())
    cuts = max(CUTS // len(open_brackets), min(LEAST_CUTS, CUTS))
    shares = [i / cuts for i in range(cuts + 1)]
    sketched = held.groupBy("bracket").agg(F.percentile_approx("v", shares, SKETCH_ACCURACY).alias("cuts")).collect()
    cell = F.lit(None).cast("int")
    for row in sketched:
        cell = F.when(F.col("bracket") == row["bracket"], _cell(sorted(set(row["cuts"])))).otherwise(cell)
    cells = (
        held.withColumn("cell", cell)
        .groupBy("bracket", "cell")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("rows"))
    )
    # At most 2 * CUTS + 3 rows per bracket from here on.
    upto = W.partitionBy("bracket").orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = cells.withColumn("through", F.sum("rows").over(upto))
    wanted = F.lit(False)
    for (_, rank), b in brackets.items():
        if b in open_brackets:
            inside = rank - b.below
            wanted = wanted | (
                (F.col("bracket") == open_brackets.index(b))
                & (F.col("through") > inside)
                & (F.col("through") - F.col("rows") <= inside)
            )
    found = ranked.where(wanted).collect()
    narrowed = dict(brackets)
    for (column, rank), b in brackets.items():
        for cell in found:
            if b in open_brackets and cell["bracket"] == open_brackets.index(b):
                start = b.below + cell["through"] - cell["rows"]
                if start <= rank < start + cell["rows"]:
                    narrowed[column, rank] = _Bracket(column, cell["low"], cell["high"], start, cell["rows"])
    return narrowed


def _read_off(values: DataFrame, brackets: dict[_Rank, _Bracket]) -> dict[_Rank, float]:
    """Sort the few rows left in the brackets and read the values at the wanted ranks."""
    answers = {r: b.low for r, b in brackets.items() if b.low == b.high}
    rest = {r: b for r, b in brackets.items() if r not in answers}
    if not rest:
        return answers
    distinct = sorted(set(rest.values()), key=lambda b: (b.column, b.low))
    counts = (
        values.select("v", _numbered(distinct).alias("bracket"))
        .where(F.col("bracket").isNotNull())
        .groupBy("bracket", "v")
        .agg(F.count("*").alias("rows"))
    )
    upto = W.partitionBy("bracket").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.withColumn("through", F.sum("rows").over(upto))
    at_rank = F.lit(False)
    for (_, rank), b in rest.items():
        inside_rank = rank - b.below
        at_rank = at_rank | (
            (F.col("bracket") == distinct.index(b))
            & (F.col("through") > inside_rank)
            & (F.col("through") - F.col("rows") <= inside_rank)
        )
    # One row per wanted rank, or fewer when a value covers several.
    for row in ranked.where(at_rank).collect():
        for (column, rank), b in rest.items():
            inside_rank = rank - b.below
            if row["bracket"] == distinct.index(b) and row["through"] - row["rows"] <= inside_rank < row["through"]:
                answers[column, rank] = row["v"]
    return answers


def _ranks_to_values(values: DataFrame, bounds: Mapping[int, _Bracket], ranks: Sequence[_Rank], sortable: int) -> dict[_Rank, float]:
    brackets = {(column, rank): bounds[column] for column, rank in ranks}
    while not all(b.settled(sortable) for b in brackets.values()):
        brackets = _narrow(values, brackets, sortable)
    return _read_off(values, brackets)


def _bounds(values: DataFrame) -> dict[int, _Bracket]:
    """The whole range of each column that has numbers, by one scan."""
    stats = values.groupBy("c").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    return {s["c"]: _Bracket(s["c"], s["lo"], s["hi"], 0, s["n"]) for s in stats}


def order_statistics(
    df: DataFrame, column: str, ranks: Sequence[int], sortable_rows: int = SORTABLE_ROWS
) -> list[float | None]:
    """Values at the given 0-based ranks of a column in ascending order, NULL and NaN left out."""
    values = _numbers(df, [column])
    bounds = _bounds(values)
    rows = bounds[0].rows if bounds else 0
    known = [(0, r) for r in sorted({r for r in ranks if 0 <= r < rows})]
    answers = _ranks_to_values(values, bounds, known, sortable_rows) if known else {}
    return [answers.get((0, r)) for r in ranks]


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], sortable_rows: int = SORTABLE_ROWS
) -> list[float | None]:
    """Exact quantiles by linear interpolation between neighbouring ranks.

    ``df`` is scanned two or more times; hand in a table scan (or a result written
    with :func:`sievework.scratch.written`), not an expensive query.
    """
    return joint_quantiles(df, [column], probabilities, sortable_rows)[column]


def joint_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], sortable_rows: int = SORTABLE_ROWS
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns, with about as many scans as one column takes."""
    values = _numbers(df, columns)
    bounds = _bounds(values)
    positions = {i: [p * (b.rows - 1) for p in probabilities] for i, b in bounds.items()}
    ranks = sorted({(i, r) for i, at in positions.items() for x in at for r in (math.floor(x), math.ceil(x))})
    found = _ranks_to_values(values, bounds, ranks, sortable_rows) if ranks else {}
    return {
        column: [_between(found[i, math.floor(x)], found[i, math.ceil(x)], x - math.floor(x)) for x in positions[i]] if i in positions else [None] * len(probabilities)
        for i, column in enumerate(columns)
    }


def _between(low: float, high: float, share: float) -> float:
    """Linear interpolation; an infinite neighbour counts only where it has a share."""
    return low if share == 0 or low == high else low + (high - low) * share


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 10_000
) -> list[float | None]:
    """Quantiles from a mergeable sketch in one scan; rank error at most 1 / ``accuracy``."""
    sketch = F.percentile_approx("v", [float(p) for p in probabilities], accuracy)
    found = _numbers(df, [column]).agg(sketch.alias("q")).first()["q"]
    return list(found) if found is not None else [None] * len(probabilities)
