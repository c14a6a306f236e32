import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefspark.constants import CRITERIA
from prefspark.functions.rubric import is_valid_rubric, parse_rubric, rubric_mean


def block(scores=(2, 2, 2, 5, 4, 3, 3), note="a note"):
    lines = [f"* {name}: {score}/5 - {note}" for name, score in zip(CRITERIA, scores)]
    return "\n".join(["Evaluation:", *lines])


BASE = block()

CASES = {
    "unchanged": (BASE, 3.0),
    "lower-case header": (BASE.replace("Evaluation:", "evaluation:"), None),
    "text around": ("Sure.\n" + BASE + "\nBye.", 3.0),
    "space before a colon": (BASE.replace("Safety:", "Safety :"), None),
    "extra line out of range": (BASE + "\n* Clarity: 9/5 - more", 4.0),
    "unknown criterion": (BASE + "\n* Tone: 3/5 - more", None),
    "second valid line": (BASE + "\n* Clarity: 3/5 - more", None),
    "missing criterion": (BASE.replace("\n* Safety: 5/5 - a note", ""), None),
    "score out of range": (BASE.replace("Clarity: 2/5", "Clarity: 6/5"), None),
    "empty": ("", None),
    "crlf": (BASE.replace("\n", "\r\n"), 3.0),
    # The validator ends lines there, the reader does not.
    "cr": (BASE.replace("\n", "\r"), None),
    "cr after the block": (BASE + "\rThat is all.", 3.0),
    "letters of another script": (BASE + "\n* Qualité: 3/5 - more", None),
    "letters of no script": (BASE + "\n* Tone!: 3/5 - more", 3.0),
    "empty note": (BASE.replace("Safety: 5/5 - a note", "Safety: 5/5 - "), None),
    "reversed": ("\n".join(["Evaluation:", *BASE.split("\n")[:0:-1]]), 3.0),
    "two spaces after the star": (BASE.replace("* ", "*  "), 3.0),
    "indented": (BASE.replace("\n", "\n   "), 3.0),
    "second header": (BASE + "\nEvaluation:", 3.0),
    "header after the lines": ("\n".join([*BASE.split("\n")[1:], "Evaluation:"]), None),
    "header with more text": (BASE.replace("Evaluation:", "Evaluation: see"), None),
    "name over a line end": (BASE.replace("* Safety", "*\nSafety"), None),
    "note on the next line": (BASE.replace("Safety: 5/5 - a", "Safety: 5/5 -\na"), None),
    "no space around the dash": (BASE.replace(" - ", "-"), 3.0),
    "null": (None, None),
}


def evaluate(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    parsed = df.withColumn("p", parse_rubric(F.col("x")))
    rows = parsed.select("i", is_valid_rubric(F.col("x")), rubric_mean(F.col("p")), "p").collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_cases(spark):
    got = evaluate(spark, [text for text, _ in CASES.values()])
    assert {k: g[1] for k, g in zip(CASES, got)} == {k: v for k, (_, v) in CASES.items()}


def test_a_valid_block_may_be_unreadable(spark):
    (valid, mean, parsed), = evaluate(spark, [CASES["space before a colon"][0]])
    assert valid and mean is None and parsed is None


def test_second_known_sequence(spark):
    (_, mean, parsed), = evaluate(spark, [block((2, 2, 2, 5, 2, 4, 3))])
    assert mean == 20 / 7
    assert [parsed[name].score for name in CRITERIA] == [2, 2, 2, 5, 2, 4, 3]


def test_last_line_and_trimmed_note_win(spark):
    (_, _, parsed), = evaluate(spark, [BASE + "\n  * Clarity: 9/5 -   later  "])
    assert tuple(parsed["Clarity"]) == (9, "later")


def statement_of_the_rule(text):
    """Line by line: (valid, scores by name or None)."""
    lines = [line.strip() for line in re.split("\r\n|\n|\r", text)]
    if "Evaluation:" not in lines:
        return False, None
    body = lines[lines.index("Evaluation:") + 1 :]
    seen = [line.strip() for line in text.split("\n")]
    seen = seen[seen.index("Evaluation:") + 1 :] if "Evaluation:" in seen else []
    names = "|".join(CRITERIA)
    strict = [re.match(rf"\*\s*({names})\s*:\s*[1-5]/5\s*-\s*.+$", line) for line in body]
    valid = sorted(m[1] for m in strict if m) == sorted(CRITERIA)
    loose = [re.match(r"\*\s*(\w+):\s*(\d)/5\s*-\s*(.+)", line) for line in seen]
    entries = {m[1]: (int(m[2]), m[3].strip()) for m in loose if m}
    return valid, entries if valid and set(entries) == set(CRITERIA) else None


ODD_LINES = st.sampled_from(
    [
        "* Clarity: 9/5 - more",
        "* Clarity : 3/5 - more",
        "* Clarity: 3/5 - more",
        "* Tone: 2/5 - more",
        "*Safety:4/5-x",
        "* Safety: 0/5 -",
        "Evaluation:",
        " Evaluation: ",
        "",
        "  ",
        "text",
        "* Clarity: 3/5 - ",
        "** Clarity: 3/5 - x",
        "* Clarity: 33/5 - x",
        "x * Clarity: 3/5 - x",
    ]
)


@st.composite
def rubric_texts(draw):
    lines = draw(st.permutations(BASE.split("\n")[1:]))[: draw(st.integers(6, 7))]
    lines = [draw(st.sampled_from(["", " ", "\t"])) + line for line in lines]
    lines.insert(draw(st.integers(0, 1)), "Evaluation:")
    for extra in draw(st.lists(ODD_LINES, max_size=2)):
        lines.insert(draw(st.integers(0, len(lines))), extra)
    return draw(st.sampled_from(["\n", "\r\n"])).join(lines)


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(rubric_texts(), min_size=100, max_size=100))
def test_against_the_rule_line_by_line(spark, texts):
    for text, (valid, _, parsed) in zip(texts, evaluate(spark, texts)):
        entries = parsed and {name: tuple(entry) for name, entry in parsed.items()}
        assert (valid, entries) == statement_of_the_rule(text), text


@pytest.mark.parametrize("score", range(1, 6))
def test_every_score(spark, score):
    (valid, mean, _), = evaluate(spark, [block((score,) * 7)])
    assert valid and mean == score
