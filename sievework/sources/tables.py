"""Versioned raw tables, processed tables, published tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.ordering import number_rows
from sievework.sources.paths import child_files, child_folders, create_new, move_folder, path_exists, remove, write_committed

#: Columns that delimited rows land with: whether a row was accepted, why not, its line, its place in the files.
ROWS, REASON, LINE, POSITIONED = "_rows", "_reason", "_line", "_position"
ACCEPTED, QUARANTINED = "accepted", "quarantined"

#: Setting: files that one task writes side by side, a folder each; without it a task sorts its rows by folder first.
_SIDE_BY_SIDE = "spark.sql.maxConcurrentOutputFileWriters"
#: One more than the folders of a landing, accepted and quarantined: a task that reaches it sorts the rows still to come.
_OPEN_FILES = 3

#: Folder of the pointers of a published table; Spark does not list it as data.
_POINTERS = "_versions"

#: Rows of a head that one task may sort; a larger one is cut from numbered ranges.
MAX_HEAD = 1_000_000


def _version_path(root: str, version: str, ingest_date: str) -> str:
    return f"{root.rstrip('/')}/version={version}/ingest_date={ingest_date}"


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Within, tasks write the rows of a few folders as they come and hold none of them for a sort."""
    before = spark.conf.get(_SIDE_BY_SIDE, None)
    if before is not None and int(before) >= _OPEN_FILES:
        yield
        return
    spark.conf.set(_SIDE_BY_SIDE, str(_OPEN_FILES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SIDE_BY_SIDE)
        else:
            spark.conf.set(_SIDE_BY_SIDE, before)


def land_raw(df: DataFrame, root: str, version: str, ingest_date: str, partition_by: Sequence[str] = ()) -> str:
    """Write an immutable raw version and return its path; a landed version is left alone.

    A version counts as landed once its write was committed.  It is written aside and moved to its place
    in one step, so no reader meets a part of it, and of two writers the first one lands.  What a
    failed write left behind is replaced.
    """
    spark, path = df.sparkSession, _version_path(root, version, ingest_date)
    if write_committed(spark, path):
        return path
    aside = f"{root.rstrip('/')}/_landing-{uuid.uuid4().hex}"
    with _side_by_side(spark):
        df.write.partitionBy(*partition_by).parquet(aside)
    if path_exists(spark, path) and not write_committed(spark, path):
        remove(spark, path)
    move_folder(spark, aside, path)
    return path


def latest_version(spark: SparkSession, root: str, version: str | None = None) -> str:
    """Path of the newest landed date of ``version`` (default: of the newest version)."""
    root = root.rstrip("/")
    versions = [version] if version else [
        name.split("=", 1)[1] for name in child_folders(spark, root) if name.startswith("version=")
    ]
    landed = []
    for candidate in versions:
        for name in child_folders(spark, f"{root}/version={candidate}"):
            path = f"{root}/version={candidate}/{name}"
            if name.startswith("ingest_date=") and write_committed(spark, path):
                landed.append((_version_order(candidate), name, path))
    if not landed:
        raise FileNotFoundError(f"no landed version under {root}")
    return max(landed)[2]


def _version_order(version: str) -> list[tuple[int, str]]:
    """Compare version numbers as numbers, so that v1.10 is newer than v1.9."""
    parts = version.lstrip("v").split(".")
    return [(int(p), "") if p.isdigit() else (-1, p) for p in parts]


def read_latest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Scan the newest landed version; only its folder is listed.  Quarantined lines are not part of it."""
    rows = spark.read.parquet(latest_version(spark, root, version))
    if ROWS not in rows.columns:
        return rows
    return rows.filter(F.col(ROWS) == ACCEPTED).drop(ROWS, REASON, LINE, POSITIONED)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Scan a processed or published table; its types were stored with it."""
    return spark.read.parquet(current_path(spark, path))


def write_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a cleaned table as Parquet, or as header CSV for export."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        # Values keep their blanks; the writer would trim them by default.
        (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    else:
        raise ValueError("fmt is parquet or csv")


def write_features(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Write the selected feature columns."""
    write_processed(df.select(*columns) if columns else df, path)


class PublishConflict(RuntimeError):
    """Another writer has published the table since this one began."""


def _pointers(spark: SparkSession, place: str) -> list[tuple[int, str]]:
    """Numbers and names of the pointers of a published table; one still being written is empty and none."""
    return sorted((int(name), name) for name, size, _ in child_files(spark, f"{place}/{_POINTERS}") if name.isdigit() and size)


def published_version(spark: SparkSession, place: str) -> int:
    """Number of the version of a published table that readers get; 0 if there is none."""
    return max((number for number, _ in _pointers(spark, place)), default=0)


def current_path(spark: SparkSession, place: str) -> str:
    """Folder of the rows of a table: where its newest pointer points, or ``place`` if it was never published."""
    place = place.rstrip("/")
    pointers = _pointers(spark, place)
    if not pointers:
        return place
    return f"{place}/{spark.read.text(f'{place}/{_POINTERS}/{pointers[-1][1]}').first()[0]}"


def publish_version(df: DataFrame, place: str, after: int | None = None) -> int:
    """Publish a table as the version that follows ``after`` (default: the one there is now); its number.

    The rows are written aside.  One small file then makes them the version that readers get; it can be
    created once, so of two writers that follow the same version the second fails with ``PublishConflict``.
    Readers keep what they resolved: nothing is replaced in place.
    """
    spark, place = df.sparkSession, place.rstrip("/")
    after = published_version(spark, place) if after is None else after
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{place}/{folder}")
    if not create_new(spark, f"{place}/{_POINTERS}/{after + 1:010d}", folder):
        remove(spark, f"{place}/{folder}")
        raise PublishConflict(f"{place} has a version {after + 1} already")
    return after + 1


def publish(tables: dict[str, DataFrame], uri: str) -> dict[str, str]:
    """Publish each table below ``uri`` (any scheme Spark can reach) as its next version; ``read_processed`` resolves a place."""
    places = {name: f"{uri.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        publish_version(df, places[name])
    return places


def head_sample(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in the order of ``order_by``, which must be unique.

    Every task keeps its first ``n`` rows and these meet in one.  A head beyond ``MAX_HEAD`` rows
    would fill that task, so there the rows are numbered in ranges, and stay spread.
    """
    order = [F.col(f"`{c}`").asc_nulls_last() for c in order_by]
    if n <= MAX_HEAD:
        return df.orderBy(*order).limit(n)
    return number_rows(df, order, "_number").filter(F.col("_number") <= n).drop("_number")
