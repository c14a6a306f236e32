"""The stand-in as a model object for the Python workers.

Its scores and texts say nothing about quality; it gives what `StandIn` gives.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from prefspark.backends.standin import HEX_DIGITS, TOKEN
from prefspark.backends.worker import WorkerBackend
from prefspark.constants import CRITERIA, RUBRIC_HEADER
from prefspark.functions.prompts import (
    CRITIQUE_HEAD,
    CRITIQUE_TAIL,
    REWRITE_HEAD,
    REWRITE_MIDDLE,
)


def _md5(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


class StandInModel:
    """`flaky` makes critiques fail as those of `StandIn` do."""

    flaky = False

    def score(self, pairs: list[tuple[str, str]]) -> list[float]:
        return [int(_md5(f"{text}\n{response}")[:8], 16) / (1 << 32) for text, response in pairs]

    def generate(
        self, chats: list[list[dict[str, str]]], n: int, seed: int, stops: Sequence[str]
    ) -> list[list[str]]:
        texts = [chat[-1]["content"] for chat in chats]
        return [
            [f"{text} {_md5(f'{k}:{seed}:{text}')}" for k in range(1, n + 1)]
            for text in texts
        ]

    def token_ends(self, texts: list[str]) -> list[list[int]]:
        return [[token.end() for token in re.finditer(TOKEN, text)] for text in texts]

    def complete(self, prompts: list[str], attempt: int = 1) -> list[str]:
        return [self._reply(prompt, attempt) for prompt in prompts]

    def _reply(self, prompt: str, attempt: int) -> str:
        if prompt.startswith(REWRITE_HEAD):
            text = prompt[len(REWRITE_HEAD) : prompt.rindex(REWRITE_MIDDLE)]
            return f"{text} {_md5(text)}"
        digest = _md5(prompt[len(CRITIQUE_HEAD) : len(prompt) - len(CRITIQUE_TAIL)])
        lines = [
            f"* {name}: {HEX_DIGITS.index(digit) % 5 + 1}/5 - note on {name}"
            for name, digit in zip(CRITERIA, digest)
        ]
        if self.flaky and attempt == 1 and HEX_DIGITS.index(digest[9]) == 0:
            raise TimeoutError("no reply")
        unreadable = self.flaky and HEX_DIGITS.index(digest[8]) % 4 >= attempt
        return "\n".join(["" if unreadable else RUBRIC_HEADER, *lines])


class FlakyStandInModel(StandInModel):
    flaky = True


def worker_backend(flaky: bool = False, **options) -> WorkerBackend:
    model = FlakyStandInModel if flaky else StandInModel
    return WorkerBackend(model, name="stand-in in workers", **options)
