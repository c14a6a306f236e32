"""Batch inference on tables. Lists stay arrays, so nothing here regroups rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.backends.base import Backend
from prefspark.constants import MAX_CONTEXT, MAX_NEW, N_RESPONSES, SEED, STOPS
from prefspark.functions.prompts import chat, critique_prompt, rewrite_prompt
from prefspark.functions.text import (
    count_units,
    keep_head,
    keep_tail,
    keep_tails,
    over_budget,
    tail_pieces,
    trim_all_at_stops,
    units,
)

# What budgets count: blank-separated units, or tokens as the backend finds them.
MEASURES = ("units", "tokens")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Even partitions for model calls; their number caps the calls in flight."""
    return df if partitions is None else df.repartition(partitions)


def _by_tokens(measure: str) -> bool:
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}, expected one of {MEASURES}")
    return measure == "tokens"


def token_budget(
    df: DataFrame,
    column: str,
    backend: Backend,
    most: int,
    *,
    keep: str = "head",
    name: str = "kept",
    flag: str = "over_budget",
) -> DataFrame:
    """Adds `name`, the head or tail of a text that has at most so many of the backend's tokens, and `flag`,
    whether that is less than the text."""
    if keep not in ("head", "tail"):
        raise ValueError(f"keep must be 'head' or 'tail', got {keep!r}")
    text, cut = F.col(column), F.col("_cuts")[0]
    part = F.left if keep == "head" else F.right
    cuts = backend.token_cuts(F.array(text), F.array(F.lit(most)), keep)
    return (
        df.withColumn("_cuts", cuts)
        .withColumns({name: part(text, cut["cut"]), flag: cut["n"] > most})
        .drop("_cuts")
    )


def _generate(
    df: DataFrame,
    instruction: str,
    backend: Backend,
    n: int,
    seed: int,
    system: str,
    stops: Sequence[str],
    max_units: int,
    measure: str,
) -> DataFrame:
    """Adds `_generated`, and `over_budget`: whether the text was cut to `max_units` first."""
    # The user text is cut before the messages are built, so they stay complete.
    shown = F.col("_shown")
    generated = backend.generate(shown, chat(shown, system), n, seed, stops)
    if _by_tokens(measure):
        rows = token_budget(df, instruction, backend, max_units, name="_shown")
    else:
        rows = df.withColumns(
            {
                "_shown": keep_head(F.col(instruction), max_units),
                "over_budget": over_budget(F.col(instruction), max_units),
            }
        )
    return rows.withColumn("_generated", generated).drop("_shown")


def generate_n(
    df: DataFrame,
    backend: Backend,
    *,
    n: int = N_RESPONSES,
    seed: int = SEED,
    system: str = "",
    stops: Sequence[str] = STOPS,
    max_units: int = MAX_CONTEXT - MAX_NEW,
    measure: str = "units",
    partitions: int | None = None,
) -> DataFrame:
    """Adds n sampled `responses` per instruction, cut at stop strings, `over_budget` and `error`.

    `measure` tells what `max_units` counts: blank-separated units, or the backend's tokens.
    """
    rows = spread(df, partitions)
    return (
        _generate(rows, "instruction", backend, n, seed, system, stops, max_units, measure)
        .withColumns(
            {
                "responses": trim_all_at_stops(F.col("_generated.texts"), stops),
                "error": F.col("_generated.error"),
            }
        )
        .drop("_generated")
    )


def with_scores(
    df: DataFrame,
    instruction: Column,
    responses: Column,
    backend: Backend,
    max_units: int,
    flags: str,
    measure: str = "units",
) -> DataFrame:
    """Adds `scores` of the tail of each conversation that fits `max_units`, and `flags` which were cut.

    Each response keeps its own tail and leaves its own room to the tail of the instruction, whose units
    are found once per row.
    """
    if _by_tokens(measure):
        return _with_token_scores(df, instruction, responses, backend, max_units, flags)
    asked, answers, left, pieces = (F.col(c) for c in ("_asked", "_answers", "_left", "_pieces"))
    # Two texts of so few bytes have no more units than that together.
    longest = F.array_max(F.transform(answers, lambda r: F.coalesce(F.octet_length(r), F.lit(0))))
    short = F.octet_length(asked) + longest <= F.lit(2 * max_units - 2)
    # What each response leaves, negative for one that does not fit by itself. Units are counted where bytes do
    # not settle it, and found where the counts do not.
    leaves = lambda r: F.lit(max_units) - F.coalesce(count_units(r), F.lit(0))
    fits = F.coalesce(count_units(asked) <= F.array_min(left), F.lit(False))
    whole = pieces.isNull()
    rows = (
        df.withColumns({"_asked": instruction, "_answers": responses})
        .withColumn("_left", F.when(~F.coalesce(short, F.lit(False)), F.transform(answers, leaves)))
        .withColumn("_pieces", F.when(left.isNotNull() & ~fits, tail_pieces(asked)))
    )
    rooms = F.transform(left, lambda n: F.greatest(n, F.lit(0)))
    seen = F.when(whole, F.transform(answers, lambda _: asked)).otherwise(keep_tails(asked, pieces, rooms))
    kept = F.when(whole, answers).otherwise(F.transform(answers, lambda r: keep_tail(r, max_units)))
    cut = lambda n: (n < 0) | (F.size(pieces) > F.greatest(n, F.lit(0)))
    told = F.when(whole, F.transform(answers, lambda _: F.lit(False))).otherwise(F.transform(left, cut))
    scored = rows.withColumns(
        {"scores": backend.score_pairs(F.when(asked.isNotNull(), seen), kept), flags: told}
    )
    return scored.drop("_asked", "_answers", "_left", "_pieces")


def _with_token_scores(
    df: DataFrame, instruction: Column, responses: Column, backend: Backend, most: int, flags: str
) -> DataFrame:
    """`with_scores` in tokens: the answers are measured first, the instruction then for the room each leaves.

    A backend that can do all of it where the model is gets the texts once.
    """
    if hasattr(backend, "score_within"):
        scored = df.withColumn("_within", backend.score_within(instruction, responses, most))
        scores = F.when(instruction.isNotNull(), F.col("_within.score"))
        return scored.withColumns({"scores": scores, flags: F.col("_within.cut")}).drop("_within")
    asked, answers, of_answers, of_asked = (F.col(c) for c in ("_asked", "_answers", "_of_answers", "_of_asked"))
    room = lambda cut: F.greatest(F.lit(most) - F.coalesce(cut["n"], F.lit(0)), F.lit(0))
    budgets = F.transform(answers, lambda _: F.lit(most))
    rows = (
        df.withColumns({"_asked": instruction, "_answers": responses})
        .withColumn("_of_answers", backend.token_cuts(answers, budgets, "tail"))
        .withColumn("_rooms", F.transform(of_answers, room))
        .withColumn("_of_asked", backend.token_cuts(F.transform(answers, lambda _: asked), F.col("_rooms"), "tail"))
    )
    seen = F.transform(of_asked, lambda cut: F.right(asked, cut["cut"]))
    kept = F.zip_with(answers, of_answers, lambda r, cut: F.right(r, cut["cut"]))
    of_one = F.transform(of_answers, lambda cut: F.coalesce(cut["n"] > most, F.lit(False)))
    of_both = F.zip_with(of_asked, F.col("_rooms"), lambda cut, room: F.coalesce(cut["n"] > room, F.lit(False)))
    scored = rows.withColumns(
        {
            "scores": backend.score_pairs(F.when(asked.isNotNull(), seen), kept),
            flags: F.zip_with(of_one, of_both, lambda a, b: a | b),
        }
    )
    return scored.drop("_asked", "_answers", "_rooms", "_of_answers", "_of_asked")


def score_responses(
    df: DataFrame,
    backend: Backend,
    *,
    max_units: int | None = None,
    measure: str = "units",
    partitions: int | None = None,
) -> DataFrame:
    """Adds `scores`, one per response and in their order.

    With `max_units` the model sees the tail of each conversation, and `over_budget`, an array too, tells
    which of them were cut. `measure` tells what is counted: units or the backend's tokens.
    """
    rows, instruction, responses = spread(df, partitions), F.col("instruction"), F.col("responses")
    if max_units is None:
        return rows.withColumn("scores", backend.score(instruction, responses))
    return with_scores(rows, instruction, responses, backend, max_units, "over_budget", measure)


def score_single(
    df: DataFrame,
    backend: Backend,
    *,
    max_units: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Adds `score` to rows of one `response` each; null where there is no response.

    With `max_units` the model sees the tail of the conversation: the response's own tail, and before
    it as much of the instruction's as fits. `over_budget` tells which conversations were cut.
    """
    rows, asked, answer = spread(df, partitions), F.col("instruction"), F.col("response")
    if max_units is not None:
        room = F.greatest(F.lit(0), F.lit(max_units) - F.size(units(answer)))
        rows = rows.withColumns(
            {
                "over_budget": F.coalesce(F.size(units(asked)) > room, F.lit(False))
                | F.coalesce(over_budget(answer, max_units), F.lit(False)),
                "_asked": keep_tail(asked, room),
                "_answer": keep_tail(answer, max_units),
            }
        )
        asked, answer = F.col("_asked"), F.col("_answer")
    scores = backend.score(asked, F.when(answer.isNotNull(), F.array(answer)))
    return (
        rows.withColumn("_scores", scores)
        .withColumn("score", F.col("_scores")[0])
        .drop("_scores", "_asked", "_answer")
    )


def critique_rewrite(
    df: DataFrame, backend: Backend, *, partitions: int | None = None
) -> DataFrame:
    """Adds `feedback`, `refined_instruction` and `error`.

    The critique goes into the rewrite prompt as it came back, without validation. After a failed
    call the later ones are skipped.
    """
    instruction = F.col("instruction")
    critique = backend.critique(instruction, critique_prompt(instruction))
    rewrite = backend.rewrite(instruction, rewrite_prompt(instruction, F.col("_critique.text")))
    return (
        spread(df, partitions)
        .withColumn("_critique", critique)
        .withColumn("_rewrite", rewrite)
        .withColumns(
            {
                "feedback": F.col("_critique.text"),
                "refined_instruction": F.col("_rewrite.text"),
                "error": F.coalesce("_critique.error", "_rewrite.error"),
            }
        )
        .drop("_critique", "_rewrite")
    )


def refine(
    df: DataFrame,
    backend: Backend,
    *,
    n: int = N_RESPONSES,
    seed: int = SEED,
    system: str = "",
    stops: Sequence[str] = STOPS,
    max_units: int = MAX_CONTEXT - MAX_NEW,
    measure: str = "units",
    partitions: int | None = None,
) -> DataFrame:
    """Critique, rewrite and regenerate: adds `feedback`, `refined_instruction`,
    `refined_responses`, `over_budget` and `error`. After an error both refined columns are null."""
    rows = critique_rewrite(df, backend, partitions=partitions)
    fine = F.col("error").isNull()
    return (
        _generate(rows, "refined_instruction", backend, n, seed, system, stops, max_units, measure)
        .withColumn("error", F.coalesce("error", "_generated.error"))
        .withColumns(
            {
                "refined_instruction": F.when(fine, F.col("refined_instruction")),
                "refined_responses": F.when(
                    fine, trim_all_at_stops(F.col("_generated.texts"), stops)
                ),
            }
        )
        .drop("_generated")
    )
