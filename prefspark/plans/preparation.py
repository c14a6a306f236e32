"""From a dataset to first responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.backends.base import Backend
from prefspark.constants import MAX_CONTEXT, MAX_NEW, N_RESPONSES, SAMPLE_FRACTION, SEED, STOPS
from prefspark.operators.inference import generate_n
from prefspark.operators.resume import drop_empty, skip_done
from prefspark.operators.sampling import sample_fraction


def project_instruction(df: DataFrame, id_col: str = "record_id", text_col: str = "instruction") -> DataFrame:
    """Id and instruction alone, and the place in the input (`seq`) where there is one; a dataset without the
    column yields nulls."""
    text = F.col(text_col) if text_col in df.columns else F.lit(None)
    return df.select(
        F.col(id_col).cast("string").alias("record_id"),
        text.cast("string").alias("instruction"),
        *[F.col(name).cast("long") for name in df.columns if name == "seq"],
    )


def sample_instructions(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    *,
    id_col: str = "record_id",
    text_col: str = "instruction",
    seed: int = SEED,
) -> DataFrame:
    """An exact share of the dataset, projected to non-empty instructions."""
    sample = sample_fraction(df, fraction, id_col=id_col, seed=seed)
    return drop_empty(project_instruction(sample, id_col, text_col))


def first_responses(
    instructions: DataFrame,
    backend: Backend,
    *,
    done: DataFrame | None = None,
    n: int = N_RESPONSES,
    seed: int = SEED,
    system: str = "",
    stops: Sequence[str] = STOPS,
    max_units: int = MAX_CONTEXT - MAX_NEW,
    measure: str = "units",
    partitions: int | None = None,
) -> DataFrame:
    """Responses for the non-empty instructions that an earlier run has not done."""
    todo = drop_empty(instructions) if done is None else skip_done(instructions, done)
    return generate_n(
        todo,
        backend,
        n=n,
        seed=seed,
        system=system,
        stops=stops,
        max_units=max_units,
        measure=measure,
        partitions=partitions,
    )
