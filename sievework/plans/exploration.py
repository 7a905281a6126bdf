"""Exploration of a cleaned table: the data behind each plot, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sievework.functions.temporal import hour_of, month_of, weekday_of
from sievework.operators.explore import (
    box_stats,
    class_balance,
    correlation_matrix,
    filter_top_k,
    spatial_grid,
    temporal_counts,
)
from sievework.operators.profile import value_counts
from sievework.plans.spec import CleaningSpec

#: Edge of a density cell in degrees, about one kilometre.
CELL = 0.01


def run_exploration(cleaned: DataFrame, spec: CleaningSpec, cell: float = CELL) -> dict[str, DataFrame]:
    """All exploration tables by name; ``cleaned`` should be a scan."""
    ts, lat, lon, category = spec.timestamp, spec.latitude, spec.longitude, spec.category
    return {
        "top_classes": value_counts(cleaned, category, 15),
        "hourly": temporal_counts(cleaned, ts, "hour"),
        "weekly": temporal_counts(cleaned, ts, "weekday"),
        "monthly": temporal_counts(cleaned, ts, "month"),
        "yearly": temporal_counts(cleaned, ts, "year"),
        "spatial": spatial_grid(filter_top_k(cleaned, category, 5), lat, lon, category, cell),
        "correlation": correlation_matrix(
            cleaned,
            [hour_of(ts), weekday_of(ts), month_of(ts), lat, lon],
            ["hour", "day_of_week", "month", lat, lon],
        ),
        "coordinate_boxes": box_stats(cleaned, [lat, lon]),
        "class_balance": class_balance(cleaned, category),
    }
