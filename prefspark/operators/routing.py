"""Where a row goes after scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.constants import ACCEPTED, CACHED, INVALID, REFINE
from prefspark.functions.scores import collapse


def route(scores: Column, gamma: float, agg: str = "min", cached: Column | None = None) -> Column:
    """Exactly one route per row: cached, then invalid, then refine below gamma, else accepted.

    A row without usable scores would satisfy neither `< gamma` nor its negation, so it gets a route
    of its own and cannot get lost.
    """
    value = collapse(scores, agg)
    by_score = (
        F.when(value.isNull(), F.lit(INVALID))
        .when(value < F.lit(float(gamma)), F.lit(REFINE))
        .otherwise(F.lit(ACCEPTED))
    )
    return by_score if cached is None else F.when(cached, F.lit(CACHED)).otherwise(by_score)


def route_counts(routed: DataFrame, *by: str) -> DataFrame:
    return routed.groupBy(*by, "route").agg(F.count("*").alias("n"))
