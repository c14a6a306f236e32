"""A deterministic backend for tests and benchmarks.

It exists so that data flow can be checked without a model. Its scores and texts say nothing about
the quality of anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.constants import CRITERIA, RUBRIC_HEADER
from prefspark.functions.binding import bind

HEX_DIGITS = "0123456789abcdef"

# The stand-in's tokens: up to four letters or digits, or any other character.
TOKEN = "[A-Za-z0-9]{1,4}|[^A-Za-z0-9]"


def _digit(digest: Column, position: Column | int) -> Column:
    """The value of one hex digit."""
    return F.instr(F.lit(HEX_DIGITS), F.substring(digest, position, 1)) - 1


def with_digest(text: Column, salt: str = "") -> Column:
    """The whole text, made another one by a digest of it."""
    return F.concat(text, F.lit(" "), F.md5(F.concat(F.lit(salt), text)))


def _reply(text: Column, error: Column | None = None) -> Column:
    error = F.lit(None).cast("string") if error is None else error
    return F.struct(text.alias("text"), error.alias("error"))


class StandIn:
    """Plain column expressions in place of model calls.

    `flaky` makes critiques fail in a reproducible way: by a digit of the instruction's digest the
    first readable attempt is 1, 2, 3 or none, and one instruction in sixteen errs on its first call.
    """

    name = "stand-in"

    def __init__(self, flaky: bool = False):
        self.flaky = flaky

    def score(self, instruction: Column, responses: Column) -> Column:
        """A uniform number in [0, 1) from a digest of both texts."""

        def share(response: Column) -> Column:
            digest = F.md5(F.concat(instruction, F.lit("\n"), response))
            return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)

        return F.when(instruction.isNotNull(), F.transform(responses, share))

    def score_pairs(self, instructions: Column, responses: Column) -> Column:
        return F.zip_with(instructions, responses, lambda i, r: self.score(i, F.array(r))[0])

    def generate(
        self,
        instruction: Column,
        messages: Column,
        n: int,
        seed: int,
        stops: Sequence[str],
    ) -> Column:
        """The whole instruction with a digest of it, the seed and the place of the response."""
        texts = F.array(*[with_digest(instruction, f"{k}:{seed}:") for k in range(1, n + 1)])
        return F.struct(
            F.when(instruction.isNotNull(), texts).alias("texts"),
            F.lit(None).cast("string").alias("error"),
        )

    def token_cuts(self, texts: Column, most: Column, keep: str) -> Column:
        def cut(text: Column, budget: Column) -> Column:
            tokens = F.regexp_extract_all(text, F.lit(TOKEN), 0)
            n = F.size(tokens)
            start = F.lit(1) if keep == "head" else F.greatest(n - budget, F.lit(0)) + 1
            kept = F.length(F.array_join(F.slice(tokens, start, F.greatest(budget, F.lit(0))), ""))
            return F.when(
                text.isNotNull(),
                F.struct(n.alias("n"), F.when(n <= budget, F.length(text)).otherwise(kept).alias("cut")),
            )

        return F.zip_with(texts, most, cut)

    def critique(self, instruction: Column, prompt: Column, attempt: int = 1) -> Column:
        asked = F.when(prompt.isNotNull(), F.md5(instruction))
        return bind(asked, lambda digest: self._critique(digest, attempt))

    def _critique(self, digest: Column, attempt: int) -> Column:
        def line(name: Column, i: Column) -> Column:
            score = (_digit(digest, i + 1) % 5 + 1).cast("string")
            return F.concat(F.lit("\n* "), name, F.lit(": "), score, F.lit("/5 - note on "), name)

        names = F.split(F.lit(" ".join(CRITERIA)), " ")
        lines = F.array_join(F.transform(names, line), "")
        text = F.concat(F.lit(RUBRIC_HEADER), lines)
        if not self.flaky:
            return _reply(text)
        # An early attempt loses its header, which makes it unreadable.
        text = F.when(_digit(digest, 9) % 4 >= attempt, lines).otherwise(text)
        failed = (_digit(digest, 10) == 0) & F.lit(attempt == 1)
        return _reply(F.when(~failed, text), F.when(failed, F.lit("TimeoutError: no reply")))

    def rewrite(self, instruction: Column, prompt: Column) -> Column:
        return _reply(F.when(prompt.isNotNull(), with_digest(instruction)))
