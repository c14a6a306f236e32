import re
import time

import pytest
from helpers import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefspark.backends.standin import StandIn
from prefspark.constants import N_RESPONSES, STOPS
from prefspark.functions import prompts
from prefspark.functions.rubric import is_valid_rubric
from prefspark.functions.text import (
    keep_head,
    keep_tail,
    keep_tails,
    over_budget,
    tail_pieces,
    trim_all_at_stops,
    trim_at_stops,
    truncate_responses,
)
from prefspark.operators.inference import score_responses


def evaluate(spark, values, *columns, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_budgets(spark):
    x = F.col("x")
    rows = evaluate(
        spark,
        ["a b  c", " a\nb\tc d ", "", None, "abcdefgh"],
        over_budget(x, 3),
        keep_head(x, 3),
        keep_tail(x, 3),
        keep_head(x, 2),
        keep_tail(x, 2),
    )
    assert rows[0] == (False, "a b  c", "a b  c", "a b", "b  c")
    assert rows[1] == (True, " a\nb\tc", "b\tc d ", " a\nb", "c d ")
    assert rows[2] == (False, "", "", "", "")
    assert rows[3][1:] == (None,) * 4
    assert rows[4] == (False,) + ("abcdefgh",) * 4


@settings(
    max_examples=1, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="ab \n\t", max_size=30), min_size=200, max_size=200))
def test_budgets_against_brute_force(spark, texts):
    x = F.col("x")
    rows = evaluate(spark, texts, over_budget(x, 4), keep_head(x, 4), keep_tail(x, 4))
    for text, got in zip(texts, rows):
        units = text.split()
        if len(units) <= 4:
            assert got == (False, text, text)
        else:
            kept, tail = re.match(r"(\s*\S+){4}", text)[0], re.search(r"(\S+\s*){4}$", text)[0]
            assert got == (True, kept, tail)
            assert kept.split() == units[:4] and tail.split() == units[-4:]


def test_tails_of_one_text_for_several_budgets(spark):
    """As each budget by itself gives."""
    texts = ["a b  c", " a\nb\tc d ", "", None, "abcdefgh", "x " * 50, " ", "one two three four five"]
    budgets = [0, 1, 2, 3, 49, 50]
    x = F.col("x")
    together = keep_tails(x, tail_pieces(x), F.array(*[F.lit(b) for b in budgets]))
    alone = F.array(*[keep_tail(x, F.lit(b)) for b in budgets])
    for text, (many, single) in zip(texts, evaluate(spark, texts, together, alone)):
        assert many == single, repr(text)


@pytest.mark.parametrize(
    "text, kept",
    [
        ("plain", "plain"),
        ("", ""),
        ("answer\nuser\n\nnext", "answer"),
        ("answer User: hi", "answer "),
        ("User: first", ""),
        ("a<|user|>b User: c", "a"),
        ("a\n<|start_header_id|>user<|end_header_id|>\n\nb", "a"),
        ("superuser\n\nx", "super"),
        ("Users: x", "Users: x"),
        ("user: x", "user: x"),
    ],
)
def test_stops(spark, text, kept):
    assert evaluate(spark, [text], trim_at_stops(F.col("x"))) == [(kept,)]


def test_stops_are_literal_text(spark):
    assert evaluate(spark, ["a.b*c"], trim_at_stops(F.col("x"), ["*"])) == [("a.b",)]
    assert evaluate(spark, ["a.b*c"], trim_at_stops(F.col("x"), [])) == [("a.b*c",)]


def test_stops_against_brute_force(spark):
    texts = [f"{a}{s}{b}{t}" for a in ("", "x ") for b in ("", "\n", "y") for s in STOPS for t in STOPS]
    rows = evaluate(spark, texts, trim_at_stops(F.col("x")))
    expected = [text[: min(text.find(s) for s in STOPS if s in text)] for text in texts]
    assert [r[0] for r in rows] == expected


def test_lists(spark):
    x = F.col("x")
    values = [["aUser:b", "c", "d"], ["a"], []]
    rows = evaluate(
        spark, values, trim_all_at_stops(x), truncate_responses(x, N_RESPONSES), kind="array<string>"
    )
    assert rows == [
        (["a", "c", "d"], ["aUser:b", "c"]),
        (["a"], ["a"]),
        ([], []),
    ]


def test_prompts(spark):
    x = F.col("x")
    rows = evaluate(
        spark,
        ["Do it"],
        prompts.chat(x, "Be brief."),
        prompts.answered_chat(x, F.lit("done")),
        prompts.critique_prompt(x),
        prompts.rewrite_prompt(x, F.lit("a critique")),
    )
    system, answered, critique, rewrite = rows[0]
    assert [tuple(m) for m in system] == [("system", "Be brief."), ("user", "Do it")]
    assert [tuple(m) for m in answered] == [("user", "Do it"), ("assistant", "done")]
    assert critique.endswith("Do it\n")
    assert rewrite.index("Do it") < rewrite.index("a critique")


def test_sample_replies_in_the_prompt_are_valid(spark):
    blocks = [prompts.rubric_block(lines) for _, lines in prompts._SKETCHES]
    assert len(blocks) == 2 and all(block in prompts.CRITIQUE_HEAD for block in blocks)
    assert evaluate(spark, blocks, is_valid_rubric(F.col("x"))) == [(True,), (True,)]


def test_text_expressions_have_no_python(spark):
    df = spark.range(1).select(trim_at_stops(keep_head(F.col("id").cast("string"), 3)))
    assert "Python" not in plan_of(df)


def test_texts_without_stops_are_not_searched_by_pattern(spark):
    """Most texts hold no stop: they cost much less than the pattern's search at every place."""
    text = F.concat(F.col("id").cast("string"), F.repeat(F.lit("some words of no harm, "), 20_000))
    rows = spark.range(0, 64, 1, 8).select(text.alias("t")).localCheckpoint()
    pattern = F.split("t", "|".join(re.escape(s) for s in STOPS), 2)[0]

    def seconds(column):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            rows.select(F.xxhash64(column)).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(trim_at_stops(F.col("t"))) < 0.6 * seconds(pattern)


def test_trimmed_as_by_the_pattern(spark):
    texts = [None, "", "user", "User:", "a User: b <|user|> c", "x\nuser", "us er", "a <|user|>", "\u00e9\nuser\n\n", "(a|b)User"]
    texts += [f"{a}{s}{b}" for s in STOPS for a in ("", "a ", "\u4e16") for b in ("", " b", s)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = F.split("t", "|".join(re.escape(s) for s in STOPS), 2)[0]
    assert all(a == b for a, b in rows.select(trim_at_stops(F.col("t")), pattern).collect())


def test_conversations_about_as_long_as_their_budget(spark):
    """Units are longer than the bytes that would settle it, so that counts decide."""
    made = lambda n, w: " ".join(f"{w}{k:09d}" for k in range(n))
    lengths = [(0, 0), (0, 10), (0, 11), (3, 7), (4, 7), (3, 8), (10, 0), (11, 0), (30, 4), (4, 30)]
    rows = [(k, made(a, "i"), [made(b, "r"), made(2, "s"), None]) for k, (a, b) in enumerate(lengths)]
    rows += [(100, None, ["a"]), (101, made(30, "i"), None), (102, made(30, "i"), [])]
    df = spark.createDataFrame(rows, "k int, instruction string, responses array<string>")

    class Shown(StandIn):
        def score_pairs(self, instructions, responses):
            return F.zip_with(instructions, responses, lambda i, r: F.concat_ws("/", i, r))

    got = score_responses(df, Shown(), max_units=10)
    for row in got.collect():
        if row.instruction is None or row.responses is None:
            assert row.scores is None
            continue
        for response, score, cut in zip(row.responses, row.scores, row.over_budget, strict=True):
            answer = (response or "").split()
            room = max(0, 10 - len(answer))
            asked = row.instruction.split()
            seen = " ".join(asked[max(0, len(asked) - room):])
            told = len(asked) > room or len(answer) > 10
            parts = [seen] if response is None else [seen, " ".join(answer[-10:])]
            assert (score, cut) == ("/".join(parts), told)
