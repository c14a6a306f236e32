"""Collapsing a row's score list."""

from pyspark.sql import Column
from pyspark.sql import functions as F

AGGREGATES = ("min", "mean", "max")


def total(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0.0), lambda acc, score: acc + score)


def mean_or_zero(scores: Column) -> Column:
    """Mean of the list, 0 for an empty one."""
    return F.when(F.size(scores) > 0, total(scores) / F.size(scores)).otherwise(F.lit(0.0))


def usable(scores: Column) -> Column:
    """True when there is a score and none of them is null or NaN."""
    each = F.forall(scores, lambda score: score.isNotNull() & ~F.isnan(score))
    return F.coalesce((F.size(scores) > 0) & each, F.lit(False))


def collapse(scores: Column, how: str) -> Column:
    """One number per list, null when the list is not usable."""
    if how == "min":
        value = F.array_min(scores)
    elif how == "max":
        value = F.array_max(scores)
    elif how == "mean":
        value = total(scores) / F.size(scores)
    else:
        raise ValueError(f"unknown aggregate {how!r}, expected one of {AGGREGATES}")
    return F.when(usable(scores), value)
