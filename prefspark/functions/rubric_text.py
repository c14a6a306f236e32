"""Telling in a worker whether a critique can be read.

It is what decides about another attempt while the model is at hand; reading stays with the columns of
`rubric`, whose rules these are.
"""

import re

from prefspark.constants import CRITERIA, RUBRIC_HEADER

# Blanks within a line; the reader ends lines at line feeds alone, so a carriage return is one of its own.
_B, _R = r"[ \t\f\x0B]*", r"[ \t\f\x0B\r]*"
_TEXT = r"[^ \t\n\x0B\f\r]"
_STRICT = re.compile(rf"^{_B}\*{_B}({'|'.join(CRITERIA)}){_B}:{_B}[1-5]/5{_B}-{_B}{_TEXT}", re.M)
_LOOSE = re.compile(rf"^{_R}\*{_R}(\w+):{_R}[0-9]/5{_R}-{_R}{_TEXT}", re.M)


def _after_header(text: str, blanks: str) -> str:
    found = re.search(rf"(?:\A|\n){blanks}{RUBRIC_HEADER}{blanks}(?:\n|\Z)", text)
    return text[found.end() :] if found else ""


def readable(text: str | None) -> bool:
    """Whether `parse_rubric` gives something for the text."""
    if text is None:
        return False
    body = _after_header(re.sub(r"\r\n?", "\n", text), _B)
    if sorted(_STRICT.findall(body)) != sorted(CRITERIA):
        return False
    seen = _after_header(text, _R) if "\r" in text else body
    return set(_LOOSE.findall(seen)) == set(CRITERIA)
