"""Mutual information of features with a class label, and the choice it leads to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.functions.info import digamma
from sievework.functions.text import as_column
from sievework.operators.ordering import number_rows, running_total
from sievework.scratch import written

#: Relative size of the noise that separates equal values of a continuous feature.
NOISE = 1e-10
#: Rows of one neighbour window.
BLOCK_ROWS = 20_000


def _long(df: DataFrame, features: Sequence[str], label: str, value, *extra: Column) -> DataFrame:
    """One row per row and feature: label, feature name, value."""
    cells = [F.struct(F.lit(f).alias("feature"), value(as_column(f)).alias("x")) for f in features]
    return df.where(as_column(label).isNotNull()).select(
        as_column(label).alias("y"), *extra, F.inline(F.array(*cells))
    )


def mi_plugin(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, mi) in nats from the contingency table of each discrete feature.

    Mutual information is H(x) + H(y) - H(x, y), so only sums of n ln n over the cells and
    over both margins are needed; the margins are sums over the cells, not over the rows.
    """
    cells = (
        _long(df, features, label, lambda c: c.cast("string"))
        .groupBy("feature", "x", "y")
        .agg(F.count("*").alias("n"))
    )

    def margin(column: str) -> DataFrame:
        return cells.groupBy("feature", column).agg(F.sum("n").alias("n")).select(
            "feature", "n", F.lit(-1).alias("sign")
        )

    terms = reduce(
        DataFrame.unionByName,
        [cells.select("feature", "n", F.lit(1).alias("sign")), margin("x"), margin("y")],
    )
    sums = terms.groupBy("feature").agg(
        F.sum(F.col("sign") * F.col("n") * F.ln("n")).alias("nlogn"),
        F.sum(F.when(F.col("sign") > 0, F.col("n"))).alias("total"),
    )
    mi = F.ln("total") + F.col("nlogn") / F.col("total")
    return sums.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))


def _noise(feature: str, key: str) -> Column:
    """Repeatable number in [-0.5, 0.5) per feature and row."""
    digest = F.md5(F.concat(F.col(feature), F.lit(":"), F.col(key)["name"]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) - F.lit(0.5)


def _jittered(df: DataFrame, features: Sequence[str], label: str, key: str) -> DataFrame:
    """Features scaled to unit deviation, equal values pulled apart; NULL counts as 0."""
    rows = _long(
        df, features, label, lambda c: F.coalesce(c.cast("double"), F.lit(0.0)), F.col("_row").alias("key")
    )
    # One row per feature.
    scales = rows.groupBy("feature").agg(
        F.stddev_pop("x").alias("_std"), F.avg(F.abs("x")).alias("_mean")
    )
    scales = scales.withColumn("_std", F.when(F.col("_std") > 0, F.col("_std")).otherwise(F.lit(1.0)))
    width = F.lit(NOISE) * F.greatest(F.lit(1.0), F.col("_mean") / F.col("_std"))
    return rows.join(F.broadcast(scales), "feature").select(
        "feature",
        "y",
        "key",
        (F.col("x") / F.col("_std") + width * _noise("feature", "key")).alias("x"),
    )


def _radii(points: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Distance of every point to its k-th nearest neighbour of the same class.

    Sorted by feature, class and value, the neighbours are at most ``k`` positions away.
    The sorted rows are cut into blocks of equal size that overlap by ``k`` rows, so a
    class of any size is spread over many tasks.
    """
    order = [F.col(c) for c in ("feature", "y", "x", "key")]
    numbered = number_rows(points, order, "position")
    place = F.col("position") - 1
    block_of = lambda p: F.floor(p / F.lit(block_rows))
    blocks = F.array_distinct(F.array(block_of(place - k), block_of(place), block_of(place + k)))
    spread = numbered.withColumn("block", F.explode(blocks))
    nearby = W.partitionBy("block").orderBy("position")
    point = F.struct("feature", "y", "x")
    distances = []
    for step in range(1, k + 1):
        for shift in (F.lag, F.lead):
            other = shift(point, step).over(nearby)
            same = (other["feature"] == F.col("feature")) & (other["y"] == F.col("y"))
            distances.append(F.when(same, F.abs(other["x"] - F.col("x"))))
    return (
        spread.select("feature", "key", "x", "n_c", "block", place.alias("place"), F.array(*distances).alias("near"))
        .where(F.col("block") == block_of(F.col("place")))
        .select("feature", "key", "x", F.get(_sorted_present("near"), _rank_of_neighbour(k) - 1).alias("radius"))
    )


def _sorted_present(distances: str) -> Column:
    return F.sort_array(F.array_compact(F.col(distances)))


def _rank_of_neighbour(k: int) -> Column:
    """k, or the last neighbour there is in a small class."""
    return F.least(F.lit(k), F.col("n_c") - 1).cast("int")


def _neighbour_counts(radii: DataFrame) -> DataFrame:
    """Per point: how many points of all classes lie strictly within its radius, itself included.

    Points and interval ends are put in one order; running totals at both ends give the
    count.  At equal positions an exclusive upper end comes before the points and an
    exclusive lower end after them.  Radii are shortened by a hair against rounding; a
    radius of zero counts the points at the same place.
    """
    x, zero = F.col("x"), F.col("radius") == 0
    reach = F.col("radius") * F.lit(1 - 1e-12)
    event = lambda at, turn, sign: F.struct(
        at.alias("at"), turn.cast("byte").alias("turn"), F.lit(sign).cast("byte").alias("sign")
    )
    events = radii.select(
        "feature",
        "key",
        F.inline(
            F.array(
                event(x + reach, F.when(zero, F.lit(2)).otherwise(F.lit(0)), 1),
                event(x, F.lit(1), 0),
                event(x - reach, F.when(zero, F.lit(0)).otherwise(F.lit(2)), -1),
            )
        ),
    )
    order = [F.col(c) for c in ("feature", "at", "turn", "key")]
    is_point = (F.col("sign") == 0).cast("bigint")
    totals = running_total(events, order, is_point, "through")
    return (
        totals.where(F.col("sign") != 0)
        .groupBy("feature", "key")
        .agg(F.sum(F.col("sign") * F.col("through")).alias("m_i"))
    )


def mi_knn(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    k: int = 3,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(feature, mi) in nats by the nearest-neighbour estimator for continuous features.

    Ross (2014), PLoS ONE 9(2): e87357, in one dimension and exact: all features at once,
    no pair of points is ever formed.  Classes with a single row are left out.  ``key``
    seeds the noise that pulls equal values apart; it may repeat or be missing.
    """
    classes = written(
        df.where(as_column(label).isNotNull())
        .groupBy(as_column(label).alias("y"))
        .agg(F.count("*").alias("n_c"))
        .where(F.col("n_c") > 1),
        "classes",
    )
    # A number of its own tells rows apart; written, so that it never changes between two reads.
    name = F.coalesce(as_column(key).cast("string"), F.lit("")).alias("name")
    numbered = df.withColumn("_row", F.struct(F.monotonically_increasing_id().alias("row"), name))
    rows_ = written(numbered.select("_row", as_column(label), *[as_column(f) for f in dict.fromkeys(features)]), "points")
    points = _jittered(rows_, features, label, key).join(classes, "y")
    # Written, because range partitioning reads its input twice: for bounds and for rows.
    radii = written(_radii(points, k, block_rows), "radii")
    counts = _neighbour_counts(radii)
    # What depends on class sizes alone is the same for every feature.
    rows = F.sum("n_c")
    by_class = F.sum(F.col("n_c") * (digamma(_rank_of_neighbour(k)) - digamma(F.col("n_c"))))
    base = classes.agg((digamma(rows) + by_class / rows).alias("base")).scalar()
    mi = base - F.col("psi_m")
    means = counts.groupBy("feature").agg(F.avg(digamma(F.col("m_i"))).alias("psi_m"))
    return means.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))


def select_features(scores: DataFrame, threshold: float = 0.005) -> DataFrame:
    """Scores above the threshold."""
    return scores.where(F.col("mi") > threshold)


def selected_names(scores: DataFrame, candidates: Sequence[str], threshold: float = 0.005) -> list[str]:
    """Names of the selected features in candidate order; the score table has one row each."""
    kept = {row["feature"] for row in select_features(scores, threshold).collect()}
    return [c for c in candidates if c in kept]
