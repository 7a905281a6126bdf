"""All queries and their SQL forms."""

from __future__ import annotations

from workload import cleaning, modelling, profiling

_ALL = {**cleaning.QUERIES, **profiling.QUERIES, **modelling.QUERIES}

QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql is not None}
