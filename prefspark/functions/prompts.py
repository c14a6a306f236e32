"""Chat messages and the two prompts of a refinement step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.constants import CRITERIA, RUBRIC_HEADER

_NAMES = ", ".join(CRITERIA)

_SKETCHES = (
    (
        "Write a function median(xs) in C that returns the median of a non-empty array of numbers, with"
        " a comment and two tests.",
        (
            (5, "every term has one meaning"),
            (5, "name, argument and result are given"),
            (4, "says nothing of arrays that are not sorted"),
            (5, "ordinary code"),
            (5, "can be written from what is stated"),
            (5, "one sentence"),
            (5, "function, comment and tests are named"),
        ),
    ),
    (
        "how do i get into my neighbours wifi without them noticing?? need it quick",
        (
            (4, "the aim is plain"),
            (2, "no device or network is described"),
            (2, "purpose and permission are left open"),
            (1, "asks for access without consent"),
            (2, "a helpful answer would do harm"),
            (4, "little besides the haste is spare"),
            (2, "steps, list or prose, nothing is said"),
        ),
    ),
)


def rubric_block(lines: tuple[tuple[int, str], ...]) -> str:
    """A rubric block with one score and note per criterion."""
    scored = [
        f"* {name}: {score}/5 - {note}"
        for name, (score, note) in zip(CRITERIA, lines, strict=True)
    ]
    return "\n".join([RUBRIC_HEADER, *scored])


CRITIQUE_HEAD = (
    "Rate how good the instruction at the end is as a task for a language model.\n"
    f"Judge these seven aspects: {_NAMES}.\n"
    f"Begin your reply with the line '{RUBRIC_HEADER}'. Then give one line per aspect, in the order"
    " above:\n"
    "* <aspect>: <score from 1 to 5>/5 - <short note>\n"
    "Write nothing else.\n\n"
    + "\n\n".join(
        f"Sample instruction: {task}\nSample reply:\n{rubric_block(lines)}"
        for task, lines in _SKETCHES
    )
    + "\n\nInstruction to rate:\n"
)
CRITIQUE_TAIL = "\n"

REWRITE_HEAD = (
    "You edit tasks that will be given to a language model. Below are a task and what a reviewer noted.\n"
    "Write the task as its author would have after reading the notes. Where a note names a gap, fill it"
    " with a sensible choice; where it names a risk, ask for something harmless that serves the same end.\n"
    "Your reply is used as it stands, so it must hold the new task and nothing besides.\n\n"
    "Task:\n"
)
REWRITE_MIDDLE = "\n\nNotes:\n"
REWRITE_TAIL = "\n"


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat(user: Column, system: str = "") -> Column:
    """Messages that ask for an answer; the backend applies its own template."""
    return F.array(_message("system", F.lit(system)), _message("user", user))


def answered_chat(instruction: Column, response: Column) -> Column:
    """Messages that are to be scored."""
    return F.array(_message("user", instruction), _message("assistant", response))


def critique_prompt(instruction: Column) -> Column:
    return F.concat(F.lit(CRITIQUE_HEAD), instruction, F.lit(CRITIQUE_TAIL))


def rewrite_prompt(instruction: Column, critique: Column) -> Column:
    return F.concat(
        F.lit(REWRITE_HEAD), instruction, F.lit(REWRITE_MIDDLE), critique, F.lit(REWRITE_TAIL)
    )
