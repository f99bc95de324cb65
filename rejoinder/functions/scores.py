"""Severity arithmetic, all in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed


def raw_score(similarity: Column, quality: Column) -> Column:
    return (
        F.lit(fixed.SIMILARITY_WEIGHT) * F.coalesce(similarity.cast("double"), F.lit(0.0))
        + F.lit(fixed.HARMFULNESS_WEIGHT) * (F.coalesce(quality.cast("double"), F.lit(0.0)) / F.lit(10.0))
    ) * F.lit(10.0)


def calibrated(raw: Column) -> Column:
    """Raw score moved to the observed range, clamped to 0..1, square root, times ten."""
    low, high = fixed.OBSERVED_RANGE
    share = (raw - F.lit(low)) / F.lit(high - low)
    return F.sqrt(F.greatest(F.lit(0.0), F.least(share, F.lit(1.0)))) * F.lit(10.0)


def severity(mean_raw: Column) -> Column:
    """0 without any hit (null mean), never below the minimum with one."""
    return F.when(mean_raw.isNull(), F.lit(0.0)).otherwise(
        F.greatest(calibrated(mean_raw), F.lit(fixed.MINIMUM_HIT_SCORE))
    )


def mitigation_level(score: Column) -> Column:
    none, mild, strong = fixed.LEVELS
    return (
        F.when(score < fixed.LEVEL_LOW, none).when(score < fixed.LEVEL_HIGH, mild).otherwise(strong)
    )


def cosine(left: Column, right: Column) -> Column:
    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    return dot(left, right) / (F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))
