"""What a table means to the flows: which column plays which part."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from sievework.operators.clean import Box


@dataclass(frozen=True)
class CleaningSpec:
    """Binding of the cleaning sequence to a raw, all-text table.

    ``order_by`` holds SQL expressions that put the rows of a key in order of arrival,
    missing values last.
    """

    key: tuple[str, ...]
    order_by: tuple[str, ...]
    critical: tuple[str, ...]
    timestamp: str
    latitude: str
    longitude: str
    category: str
    box: Box
    first_day: dt.date
    as_of: dt.date
    rare_threshold: int
    fill_unknown: tuple[str, ...] = ()
    longs: tuple[str, ...] = ()
    long_keys: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    other_timestamps: tuple[str, ...] = ()
    fence_factor: float = 1.5

    @property
    def fence_columns(self) -> tuple[str, str]:
        return (self.latitude, self.longitude)


@dataclass(frozen=True)
class FeatureSpec:
    """Binding of the feature flow to a cleaned table."""

    timestamp: str
    category: str
    area: str
    place: str
    place_keywords: tuple[str, ...]
    key: str
    candidates: tuple[str, ...]
    label: str = "category_label"
    area_code: str = "area_enc"
    place_flag: str = "is_crowded"
    #: Rows to score on; None: all of them, which contingency tables can take.
    sample_rows: int | None = 50_000
    seed: int = 42
    threshold: float = 0.005
    #: Candidates scored from their contingency table; the rest by nearest neighbours.
    discrete: tuple[str, ...] = ()
