"""From rows of a run to pairs of original and refined data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_REPLACED = ("instruction", "responses", "original_instruction", "original_responses")


def with_lineage(df: DataFrame) -> DataFrame:
    """Fills `original_*`: what the row carries, or its current values if it was never refined."""
    return df.withColumns(
        {
            "original_instruction": F.coalesce("original_instruction", "instruction"),
            "original_responses": F.coalesce("original_responses", "responses"),
        }
    )


def both_sides(df: DataFrame) -> DataFrame:
    """Each row as an original and a refined one, told apart by `side`, in one pass."""
    lineage = with_lineage(df)
    kept = [c for c in lineage.columns if c not in _REPLACED]
    original = F.struct(
        F.lit("original").alias("side"),
        F.col("original_instruction").alias("instruction"),
        F.col("original_responses").alias("responses"),
    )
    refined = F.struct(F.lit("refined").alias("side"), F.col("instruction"), F.col("responses"))
    return lineage.select(*kept, F.inline(F.array(original, refined)))
