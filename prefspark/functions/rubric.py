"""Validating and reading rubric text.

A block is read by matching patterns over the whole text and not line by line, so a pattern must not
run over a line end: its blanks are those within a line.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.constants import CRITERIA, RUBRIC_HEADER
from prefspark.functions.binding import bind
from prefspark.functions.text import BLANKS

_B = r"[ \t\f\x0B]*"
# The reader ends lines at line feeds alone; a carriage return is one of its blanks.
_R = r"[ \t\f\x0B\r]*"
_STRICT = rf"(?dm)^{_B}\*{_B}({'|'.join(CRITERIA)}){_B}:{_B}[1-5]/5{_B}-{_B}\S"
_LOOSE = rf"(?dm)^{_R}\*{_R}([\p{{L}}\p{{N}}_]+):{_R}(\d)/5{_R}-{_R}(\S[^\n]*)"


def _after_header(text: Column, blanks: str) -> Column:
    return F.regexp_extract(text, rf"(?:\A|\n){blanks}{RUBRIC_HEADER}{blanks}(?:\n|\z)([\s\S]*)", 1)


def rubric_body(text: Column) -> Column:
    """Text after the first header line, with plain line ends; empty when there is no header."""
    plain = F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r\n?", "\n"))
    return _after_header(F.coalesce(plain, text), _B)


def _all(body: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(body, F.lit(pattern), group)


def _names(names: Iterable[str]) -> Column:
    return F.split(F.lit(" ".join(names)), " ")


def _are_the_criteria(names: Column) -> Column:
    return F.array_sort(names) == _names(sorted(CRITERIA))


def _valid(body: Column) -> Column:
    return _are_the_criteria(_all(body, _STRICT, 1))


def is_valid_rubric(text: Column) -> Column:
    """Each criterion scored by exactly one well-formed line; other lines do not matter."""
    return F.coalesce(_valid(rubric_body(text)), F.lit(False))


def parse_rubric(text: Column) -> Column:
    """Criterion -> (score, note), the last line of a criterion winning; null when not readable.

    Reading is looser than validation about digits and stricter about the colon, so a valid block
    may still be unreadable: its names must be the seven criteria and nothing else.
    """

    def entries(found: Column) -> Column:
        def entry(name: Column) -> Column:
            # The lists are reversed, so the first place of a name is its last line.
            place = (F.array_position(found["names"], name) - 1).cast("int")
            return F.struct(
                F.get(found["scores"], place).cast("int").alias("score"),
                F.btrim(F.get(found["notes"], place), F.lit(BLANKS)).alias("note"),
            )

        names = _names(CRITERIA)
        return F.when(
            _are_the_criteria(F.array_distinct(found["names"])),
            F.map_from_arrays(names, F.transform(names, entry)),
        )

    def read(body: Column) -> Column:
        # Without a carriage return the validator and the reader see the same lines.
        seen = F.when(F.contains(text, F.lit("\r")), _after_header(text, _R)).otherwise(body)
        found = bind(
            seen,
            lambda lines: F.struct(
                *[
                    F.reverse(_all(lines, _LOOSE, group)).alias(field)
                    for group, field in enumerate(("names", "scores", "notes"), start=1)
                ]
            ),
        )
        return F.when(_valid(body), bind(found, entries))

    return bind(rubric_body(text), read)


def rubric_mean(parsed: Column) -> Column:
    total = F.aggregate(F.map_values(parsed), F.lit(0), lambda acc, entry: acc + entry["score"])
    return total / F.lit(float(len(CRITERIA)))
