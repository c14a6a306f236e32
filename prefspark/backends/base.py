"""What the operators ask of a model backend."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column


class Backend(Protocol):
    """Every method maps columns to a column, and a null input skips the model call.

    Texts come back as `struct<text, error>`, so one failed call marks its row and not the job.
    """

    name: str

    def score(self, instruction: Column, responses: Column) -> Column:
        """`array<double>`, one score per response; null where scoring failed."""

    def score_pairs(self, instructions: Column, responses: Column) -> Column:
        """As `score`, with an array that holds an instruction for each response."""

    def generate(
        self,
        instruction: Column,
        messages: Column,
        n: int,
        seed: int,
        stops: Sequence[str],
    ) -> Column:
        """`struct<texts: array<string>, error: string>` with n sampled responses."""

    def critique(self, instruction: Column, prompt: Column, attempt: int = 1) -> Column:
        """`struct<text, error>` with the rubric text for an instruction."""

    def token_cuts(self, texts: Column, most: Column, keep: str) -> Column:
        """For arrays of texts and of budgets in tokens `array<struct<n: int, cut: int>>`: the tokens of each
        text, and how many characters of its head or tail (`keep`) fit its budget; all of them where it fits.

        Without it, budgets are counted in units.
        """

    # A backend may have `score_within(instruction, responses, most)`: `array<struct<score, cut>>` with the score
    # of each conversation's tail of at most so many tokens, and whether that was cut. Without it, `token_cuts`
    # and `score_pairs` follow in the plan.

    # A backend may have `critique_until(instruction, prompt, attempts)`: `struct<text, error>` with the first of
    # up to so many critiques that can be read, else the last one. Without it, attempts follow in the plan.

    def rewrite(self, instruction: Column, prompt: Column) -> Column:
        """`struct<text, error>` with the improved instruction."""
