"""Tolerant conversions from text: what cannot be read becomes NULL or a default, never an error."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import as_column, standardize

#: 12-hour US timestamp; one-digit month, day and hour are accepted.
US_TIMESTAMP = "M/d/yyyy h:mm:ss a"


#: Session zones in which every wall-clock time exists.
_ZONES_WITHOUT_GAPS = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _session_zone_has_gaps() -> bool:
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone", None) if session is not None else None
    return zone not in _ZONES_WITHOUT_GAPS


def parse_timestamp(column: Column | str, fmt: str = US_TIMESTAMP) -> Column:
    """Zone-less timestamp, NULL where the text does not match ``fmt``.

    The tolerant parser answers in the session zone.  Outside UTC that moves wall-clock
    times which fall into a daylight-saving gap, so there it only decides validity and the
    value comes from the zone-less parser.
    """
    text = as_column(column)
    parsed = F.try_to_timestamp(text, F.lit(fmt))
    if not _session_zone_has_gaps():
        return parsed.cast("timestamp_ntz")
    return F.when(parsed.isNotNull(), F.to_timestamp_ntz(text, F.lit(fmt)))


def to_double(column: Column | str) -> Column:
    """Number from text; unreadable text, infinities and NaN become NULL.

    Letters that Java takes as number suffixes or hexadecimal marks, and Spark's cast
    with it, are not part of a number in a data file.
    """
    raw = as_column(column)
    value = F.when(~raw.cast("string").rlike("[dDfFpP]"), raw.try_cast("double"))
    return F.nanvl(value, F.lit(None).cast("double"))


def to_long(column: Column | str, default: int | None = 0) -> Column:
    """Whole number from text; the fraction is cut off, unreadable text gives ``default``."""
    # Whole numbers are read as such first: a double holds only 53 bits.
    exact = F.trim(as_column(column).cast("string"))
    whole = F.when(exact.rlike(r"^[+-]?[0-9]+$"), exact.try_cast("bigint"))
    value = F.coalesce(whole, to_double(column).try_cast("bigint"))
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def to_bool(column: Column | str) -> Column:
    """TRUE / FALSE in any case and with surrounding whitespace, NULL for all other text."""
    text = standardize(as_column(column).cast("string"))
    return F.when(text == "TRUE", F.lit(True)).when(text == "FALSE", F.lit(False))
