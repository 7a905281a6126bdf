"""Joining a large table to a derived lookup table of unknown size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sievework.scratch import written


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` to ``lookup`` after writing ``lookup`` out.

    Once written, its size is measured, not estimated: Spark broadcasts it when it is
    below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both sides,
    splitting the partitions of frequent keys (adaptive skew join).  It is also computed
    once, whatever the join does.
    """
    return facts.join(written(lookup, "lookup"), on, how)
