"""Text budgets and stop strings."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.constants import STOPS

BLANKS = " \t\r\n\f"
_UNIT = r"\S+"


def units(text: Column) -> Column:
    """Whitespace-separated units, the budget measure when no tokenizer is at hand."""
    return F.regexp_extract_all(text, F.lit(_UNIT), 0)


def _within(text: Column, budget: int | Column) -> Column:
    # n units need at least 2n - 1 bytes, so most texts are settled by their stored size.
    return (F.octet_length(text) <= 2 * budget) | (F.regexp_count(text, F.lit(_UNIT)) <= budget)


def over_budget(text: Column, budget: int | Column) -> Column:
    return ~_within(text, budget)


def keep_head(text: Column, budget: int) -> Column:
    """The text itself when it fits the budget, else what reaches to the end of unit `budget`."""
    pieces = F.regexp_extract_all(text, F.lit(rf"\s*{_UNIT}"), 0)
    head = F.array_join(F.slice(pieces, 1, budget), "")
    return F.when(_within(text, budget), text).otherwise(head)


def tail_pieces(text: Column) -> Column:
    """The units of a text with the blanks after each, of which tails are made."""
    return F.regexp_extract_all(text, F.lit(rf"{_UNIT}\s*"), 0)


def keep_tail(text: Column, budget: int | Column) -> Column:
    """The text itself when it fits the budget, else all from the first of the last `budget` units."""
    pieces = tail_pieces(text)
    start = F.greatest(F.size(pieces) - budget, F.lit(0)) + 1
    tail = F.array_join(F.slice(pieces, start, F.greatest(F.lit(budget) if isinstance(budget, int) else budget, F.lit(0))), "")
    return F.when(_within(text, budget), text).otherwise(tail)


def count_units(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_UNIT))


def keep_tails(text: Column, pieces: Column, budgets: Column) -> Column:
    """`keep_tail` of one text for each of an array of budgets. `pieces`, a column of its `tail_pieces`, is
    found once."""
    n = F.size(pieces)
    start = lambda b: F.greatest(n - b, F.lit(0)) + 1
    tail = lambda b: F.array_join(F.slice(pieces, start(b), b), "")
    return F.transform(budgets, lambda b: F.when(n <= b, text).otherwise(tail(b)))


def trim_at_stops(text: Column, stops: Sequence[str] = STOPS) -> Column:
    """Text before the earliest stop string; the whole text when none occurs."""
    if not stops:
        return text
    any_stop = "|".join(re.escape(stop) for stop in stops)
    # Few texts hold a stop; looking for the strings is much cheaper than the pattern, place by place.
    held = reduce(or_, [F.contains(text, F.lit(stop)) for stop in stops])
    return F.when(held, F.split(text, any_stop, 2)[0]).otherwise(text)


def trim_all_at_stops(texts: Column, stops: Sequence[str] = STOPS) -> Column:
    return F.transform(texts, lambda text: trim_at_stops(text, stops))


def truncate_responses(responses: Column, n: int) -> Column:
    return F.slice(responses, 1, n)
