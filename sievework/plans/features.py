"""From a cleaned table to the selected feature matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import as_column
from sievework.operators.encode import label_encode, label_mapping
from sievework.operators.features import calendar_flags, calendar_parts, keyword_flag
from sievework.operators.sampling import fixed_sample
from sievework.operators.selection import mi_knn, mi_plugin, selected_names
from sievework.plans.spec import FeatureSpec
from sievework.scratch import written
from sievework.sources.documents import write_json_document
from sievework.sources.tables import write_features


@dataclass(frozen=True)
class Features:
    """Result of the flow: matrix, label maps, scores, and the selected names."""

    matrix: DataFrame
    label_map: DataFrame
    area_map: DataFrame
    scores: DataFrame
    selected: tuple[str, ...]


def derive(cleaned: DataFrame, spec: FeatureSpec, label_map: DataFrame, area_map: DataFrame) -> DataFrame:
    """All derived columns: one projection and two lookups."""
    table = calendar_flags(calendar_parts(cleaned, spec.timestamp), spec.timestamp)
    table = keyword_flag(table, spec.place, spec.place_keywords, spec.place_flag)
    table = label_encode(table, spec.category, spec.label, label_map)
    return label_encode(table, as_column(spec.area).cast("string"), spec.area_code, area_map)


def score(cleaned: DataFrame, spec: FeatureSpec, label_map: DataFrame, area_map: DataFrame) -> DataFrame:
    """Mutual information of every candidate with the label, on a sample of fixed size or on all rows.

    Rows are sampled before features are derived; the choice only reads the key column.
    """
    sample = cleaned if spec.sample_rows is None else fixed_sample(cleaned, spec.sample_rows, spec.seed, spec.key)
    derived = derive(sample, spec, label_map, area_map)
    columns = [*dict.fromkeys([spec.key, spec.label, *spec.candidates])]
    filled = derived.select(*[as_column(c) for c in columns]).fillna(0, subset=list(spec.candidates))
    filled = written(filled, "sample")
    continuous = [c for c in spec.candidates if c not in spec.discrete]
    scores = []
    if continuous:
        scores.append(mi_knn(filled, continuous, spec.label, spec.key))
    if spec.discrete:
        scores.append(mi_plugin(filled, list(spec.discrete), spec.label))
    return written(scores[0] if len(scores) == 1 else scores[0].unionByName(scores[1]), "scores")


def run_features(cleaned: DataFrame, spec: FeatureSpec) -> Features:
    """Derive, score, select; ``cleaned`` should be a scan.

    Every column has a code map of its own.
    """
    label_map = label_mapping(cleaned, spec.category)
    area_map = label_mapping(cleaned, as_column(spec.area).cast("string"))
    derived = derive(cleaned, spec, label_map, area_map)
    scores = score(cleaned, spec, label_map, area_map)
    names = selected_names(scores, spec.candidates, spec.threshold)
    return Features(
        matrix=derived.select(*[as_column(c) for c in names], F.col(spec.label)),
        label_map=label_map,
        area_map=area_map,
        scores=scores,
        selected=tuple(names),
    )


def save_features(result: Features, path: str, catalog_zone: str) -> None:
    """Write the matrix, one code map per encoded column, and the scores."""
    write_features(result.matrix, path)
    zone = catalog_zone.rstrip("/")
    write_json_document(result.label_map, f"{zone}/label_encoding", single_file=False)
    write_json_document(result.area_map, f"{zone}/area_encoding", single_file=False)
    write_json_document(result.scores, f"{zone}/feature_scores")
