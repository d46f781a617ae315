"""Drift of a distribution against a profile, from sketches that add up.

A quantile sketch per group (a day, a source) is kept; sketches of any groups are merged without
reading the values again. The largest gap between the merged curve and the profile's curve is known
up to an error that the size of the sketch fixes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.schemas import AGE_PROFILE

# Size of a sketch: some kilobytes, whatever it has seen.
K = 400
# Points at which the two curves are compared.
POINTS = 199


def rank_error(k: int = K) -> float:
    """Share of values by which a rank may be off (99 of 100 times), by the sketch's authors."""
    return 2.296 / k**0.9723


def distribution_sketches(df: DataFrame, column: str, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``by..., n, sketch``; nulls are left out, a group without values has a null sketch."""
    value = F.col(column).cast("double")
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """Sketches of larger groups from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def profile_points(profile: Mapping[str, float] = AGE_PROFILE, points: int = POINTS) -> list[tuple[float, float]]:
    """(value, share of values up to it) along the profile's bell curve, cut at its bounds."""
    curve = NormalDist(profile["mean"], profile["stddev"])
    low, high = curve.cdf(profile["min"]), curve.cdf(profile["max"])
    shares = [(i + 1) / (points + 1) for i in range(points)]
    return [(curve.inv_cdf(low + s * (high - low)), s) for s in shares]


def distribution_gap(
    sketches: DataFrame, profile: Mapping[str, float] = AGE_PROFILE, k: int = K, points: int = POINTS
) -> DataFrame:
    """Adds ``gap``, the largest distance of the two curves at the points, and ``gap_error``.

    Between two points the curves can part by one step more, which the error includes.
    """
    at = profile_points(profile, points)

    def away(value: float, share: float) -> Column:
        return F.abs(F.kll_sketch_get_rank_double("sketch", F.lit(value)) - share)

    gap = F.array_max(F.array(*[away(v, s) for v, s in at]))
    known = sketches.withColumn("gap", F.when(F.col("n") > 0, gap))
    return known.withColumn("gap_error", F.lit(rank_error(k) + 1 / (points + 1)))


def dq_drift(
    sketches: DataFrame, subject: Column, max_gap: float, profile: Mapping[str, float] = AGE_PROFILE, k: int = K
) -> DataFrame:
    """``check, subject, violations, total, passed``: a group fails when its gap is surely larger than
    allowed, and when it has no values."""
    gaps = distribution_gap(sketches, profile, k)
    far = F.coalesce(F.col("gap") - F.col("gap_error") > max_gap, F.lit(True))
    return gaps.select(
        F.lit("distribution_drift").alias("check"),
        subject.alias("subject"),
        far.cast("bigint").alias("violations"),
        F.col("n").alias("total"),
        (~far).alias("passed"),
    )
