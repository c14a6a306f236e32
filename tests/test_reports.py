import pytest
from helpers import ByLength
from pyspark.sql import functions as F
from test_rubric import BASE

from prefspark.backends.standin import StandIn
from prefspark.constants import PARSE_FAILURE
from prefspark.operators.inference import generate_n
from prefspark.operators.reports import (
    first_valid_attempt,
    reward_mean,
    reward_mean_per_response,
    reward_per_record,
    reward_report,
    rubric_report,
    rubric_report_live,
    text_field,
)
from prefspark.schemas import ATTEMPTS

BAD = "no rubric"
OTHER = BASE.replace("Clarity: 2", "Clarity: 3")

LOG = {
    "first": [BASE, OTHER],
    "second": [BAD, OTHER, BASE],
    "third": [BAD, BAD, BASE],
    "fourth": [BAD, BAD, BAD, BASE],
    "none": [BAD],
    "raised": [BAD, ("TimeoutError: t",), BASE],
    "raised late": [BASE, ("TimeoutError: t",)],
}


def attempts(spark):
    rows = [
        (key, n, *((None, a[0]) if isinstance(a, tuple) else (a, None)))
        for key, tries in LOG.items()
        for n, a in enumerate(tries, start=1)
    ]
    return spark.createDataFrame(rows[::-1], ATTEMPTS).repartition(4)


def test_first_valid_attempt(spark):
    got = {r.record_id: (r.feedback, r.error) for r in first_valid_attempt(attempts(spark)).collect()}
    assert got == {
        "first": (BASE, None),
        "second": (OTHER, None),
        "third": (BASE, None),
        "raised": (None, "TimeoutError: t"),
        "raised late": (BASE, None),
    }
    more = first_valid_attempt(attempts(spark), max_retries=4)
    assert "fourth" in {r.record_id for r in more.collect()}


@pytest.fixture
def records(spark):
    rows = [(key, "text") for key in LOG] + [("null", None), ("unseen", "text"), ("first", "")]
    return spark.createDataFrame(rows, "record_id string, instruction string")


def test_report_from_a_log(spark, records):
    report = rubric_report(records, attempts(spark)).collect()
    assert sorted(r.record_id for r in report) == ["first", "first", "raised late", "second", "third"]
    assert {r.feedback_avg_score for r in report if r.record_id == "first"} == {3.0}
    kept = rubric_report(records, attempts(spark), keep_failed=True)
    reasons = {r.record_id: r.failure_reason for r in kept.collect()}
    assert kept.count() == records.count()
    assert reasons["raised"] == "exception: TimeoutError: t"
    assert {reasons[k] for k in ("null", "unseen", "none", "fourth")} == {PARSE_FAILURE}
    failed = kept.filter("failure_reason is not null")
    assert failed.filter("feedback is not null or feedback_json is not null").isEmpty()


def test_live_report_asks_only_what_is_open(spark):
    class Counting(StandIn):
        """Replies with whether it was asked."""

        def critique(self, instruction, prompt, attempt=1):
            text = F.when(F.col("first_valid") <= attempt, F.lit(BASE)).otherwise(F.lit(BAD))
            fails = (F.col("fails_at") == attempt) & prompt.isNotNull()
            return F.struct(
                F.when(prompt.isNotNull() & ~fails, text).alias("text"),
                F.when(fails, F.lit("E: x")).alias("error"),
            )

    rows = [("a", "t", 1, 2), ("b", "t", 2, 3), ("c", "t", 9, 0), ("d", "t", 3, 2), ("e", None, 1, 0)]
    df = spark.createDataFrame(
        rows, "record_id string, instruction string, first_valid int, fails_at int"
    )
    report = rubric_report_live(df, Counting(), keep_failed=True).collect()
    assert {r.record_id: r.failure_reason for r in report} == {
        "a": None, "b": None, "c": PARSE_FAILURE, "d": "exception: E: x", "e": PARSE_FAILURE,
    }
    assert rubric_report_live(df, Counting()).count() == 2
    assert rubric_report_live(df, Counting(), max_retries=1).count() == 1


def test_reward_reports_agree(spark):
    rows = [("1", "abcd", ["ab", "abcd", "a"]), ("2", "ab", []), ("3", "ab", ["ab"])]
    df = spark.createDataFrame(rows, "record_id string, instruction string, responses array<string>")
    report = reward_report(df, ByLength())
    by_id = {r.record_id: r for r in report.collect()}
    assert by_id["1"].scores == [1 / 3, 0.5, 0.2] and by_id["2"].avg_score == 0
    total = 1 / 3 + 0.5 + 0.2 + 0.5
    assert reward_mean(report).first().avg_score == pytest.approx(total / 6)
    assert reward_mean(report, n_responses=1).first().avg_score == pytest.approx(total / 3)
    single = report.select("record_id", F.explode_outer("scores").alias("score"))
    assert reward_mean_per_response(single).first().avg_score == pytest.approx(total / 6)
    per_record = {r.record_id: r.avg_score for r in reward_per_record(single).collect()}
    assert per_record == {k: pytest.approx(r.avg_score) for k, r in by_id.items()}
    assert reward_mean(report.limit(0)).first().avg_score == 0
    assert reward_mean_per_response(single.limit(0)).first().avg_score == 0


def test_reports_compose(spark):
    """Over generated rows, over an earlier report, and over a log that carries feedback."""
    df = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", None)], "record_id string, instruction string")
    log = spark.createDataFrame(
        [("1", 1, BASE, None), ("2", 1, None, "E: x")], "record_id string, attempt int, feedback string, error string"
    )
    made = generate_n(df, StandIn())
    for report in (lambda rows: rubric_report(rows, log, keep_failed=True), lambda rows: rubric_report_live(rows, StandIn(), keep_failed=True)):
        once = report(made)
        again = report(once)
        assert "error" in once.columns and again.columns == once.columns
        assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    reasons = {r.record_id: r.failure_reason for r in rubric_report(made, log, keep_failed=True).collect()}
    assert reasons == {"1": None, "2": "exception: E: x", "3": PARSE_FAILURE}


def test_lines_without_a_text_stay_with_a_reason(spark):
    lines = [("1", '{"instruction": "a"}'), ("2", '{"instruction": 5}'), ("3", "{}"), ("4", "{bad"), ("5", None)]
    records = text_field(spark.createDataFrame(lines, "record_id string, value string"), "instruction")
    log = spark.createDataFrame([("1", 1, BASE, None), ("2", 1, BASE, None)], "record_id string, attempt int, feedback string, error string")
    kept = rubric_report(records, log, keep_failed=True).collect()
    assert {r.record_id: r.failure_reason for r in kept} == {"1": None} | {k: PARSE_FAILURE for k in "2345"}
