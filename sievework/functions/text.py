"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a dataframe CSV reader takes as missing by default.
DEFAULT_MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def as_column(column: Column | str) -> Column:
    """Accept a column or a column name (which may hold blanks or dots)."""
    return F.col(f"`{column}`") if isinstance(column, str) else column


def null_if_missing(column: Column | str, tokens: Sequence[str] = DEFAULT_MISSING_TOKENS) -> Column:
    """NULL where the text is one of the missing-value tokens."""
    text = as_column(column)
    return F.when(text.isin(list(tokens)), F.lit(None)).otherwise(text)


# The characters that count as whitespace in Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (plain ``trim`` only removes blanks)."""
    return F.trim(as_column(column), F.lit(WHITESPACE))


def standardize(column: Column | str) -> Column:
    """Strip and upper-case; NULL stays NULL."""
    return F.upper(strip(column))


def contains_any(column: Column | str, keywords: Sequence[str]) -> Column:
    """1 when the upper-cased text contains any keyword as a substring, else 0; NULL gives 0."""
    text = F.upper(as_column(column))
    hit = F.lit(False)
    for keyword in keywords:
        hit = hit | F.contains(text, F.lit(keyword.upper()))
    return F.coalesce(hit.cast("int"), F.lit(0))
