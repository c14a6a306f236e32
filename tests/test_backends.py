import os
import re
import sys
import threading
import time

import pyarrow as pa
import pytest
from helpers import TESTDATA, plan_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from prefspark.backends import worker
from prefspark.backends.standin import TOKEN, StandIn
from prefspark.backends.worker import WorkerBackend, _in_flight, _outcomes, _until
from prefspark.catalog import views
from prefspark.catalog.standin_model import StandInModel, worker_backend
from prefspark.constants import STOPS
from prefspark.functions.rubric import parse_rubric
from prefspark.functions.rubric_text import readable
from prefspark.operators.inference import critique_rewrite, generate_n, refine, score_responses, token_budget
from prefspark.operators.reports import rubric_report_live

SF_DIR = f"{TESTDATA}/sf0.001"

# The workers cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def called(run, items, batch_size, threads, weight=len):
    """The outcomes of one batch of items."""
    ((_, outcomes),) = _in_flight([(None, items)], lambda some: _outcomes(run, some), batch_size, threads, weight)
    return outcomes


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def pairs(spark):
    return views.pairs(spark, SF_DIR)


@pytest.mark.parametrize(
    "operator",
    [
        generate_n,
        score_responses,
        critique_rewrite,
        lambda df, backend: refine(df, backend, seed=7),
    ],
)
def test_both_backends_agree(pairs, operator):
    assert rows(operator(pairs, StandIn())) == rows(operator(pairs, worker_backend(batch_size=3)))


def test_partitions_cap_the_tasks(pairs):
    assert score_responses(pairs, StandIn(), partitions=3).rdd.getNumPartitions() == 3
    assert rows(score_responses(pairs, worker_backend(threads=4), partitions=2)) == rows(
        score_responses(pairs, StandIn())
    )


def test_only_model_inputs_go_to_python(spark):
    df = spark.createDataFrame(
        [("1", "a", ["b"], "wide")], "record_id string, instruction string, responses array<string>, p string"
    )
    plan = plan_of(score_responses(df, worker_backend()))
    call = plan.split("ArrowEvalPython [")[1].split("]")[0]
    assert "instruction" in call and "responses" in call and "p#" not in call


class PickyModel(StandInModel):
    """Raises for texts with the word bad."""

    def score(self, pairs):
        if any("bad" in text + response for text, response in pairs):
            raise TimeoutError("slow")
        return super().score(pairs)

    def generate(self, chats, n, seed, stops):
        assert stops == STOPS
        if any("bad" in chat[-1]["content"] for chat in chats):
            raise TimeoutError("slow")
        return [["one<|user|>two", "User:"] for _ in chats]

    def complete(self, prompts):
        if any("bad" in prompt for prompt in prompts):
            raise TimeoutError("slow")
        return super().complete(prompts)


def test_a_failing_row_does_not_fail_its_batch(spark):
    df = spark.createDataFrame(
        [
            ("1", "good", ["x", "y"]),
            ("2", "bad", ["x"]),
            ("3", "fine", ["bad", "z"]),
            ("4", None, ["x"]),
            ("5", "ok", []),
            ("6", "ok", None),
        ],
        "record_id string, instruction string, responses array<string>",
    ).coalesce(1)
    backend = WorkerBackend(PickyModel, batch_size=10)
    scores = {r.record_id: r.scores for r in score_responses(df, backend).collect()}
    score = lambda *pair: StandInModel().score([pair])[0]
    assert scores == {
        "1": [score("good", "x"), score("good", "y")], "2": [None], "3": [None, score("fine", "z")],
        "4": None, "5": [], "6": None,
    }

    generated = {r.record_id: (r.responses, r.error) for r in generate_n(df, backend).collect()}
    assert generated["1"] == (["one", ""], None)
    assert generated["2"] == (None, "TimeoutError: slow")
    assert generated["4"] == (None, None)

    refined = {r.record_id: r for r in refine(df, backend).collect()}
    assert refined["2"].error == "TimeoutError: slow"
    assert refined["2"].refined_instruction is refined["2"].refined_responses is None
    assert refined["1"].refined_instruction.startswith("good ") and refined["1"].error is None


def test_a_refinement_fails_as_a_whole(spark):
    class NoAnswers(StandInModel):
        def generate(self, chats, n, seed, stops):
            raise ValueError("no")

    df = spark.createDataFrame(
        [("1", "text", ["x"])], "record_id string, instruction string, responses array<string>"
    )
    row = refine(df, WorkerBackend(NoAnswers)).first()
    assert row.error == "ValueError: no"
    assert row.refined_instruction is row.refined_responses is None
    assert row.feedback.startswith("Evaluation:")


def test_batches_hold_similar_lengths_and_results_keep_their_order():
    seen = []

    def run(items):
        seen.append(items)
        return [item.upper() for item in items]

    items = ["ccc", "a", "dddd", "bb"]
    assert [v for v, _ in called(run, items, 2, 1)] == ["CCC", "A", "DDDD", "BB"]
    assert seen == [["a", "bb"], ["ccc", "dddd"]]


def test_one_model_per_worker_process(spark, tmp_path):
    folder = str(tmp_path)

    class Counted(StandInModel):
        def __init__(self):
            import os
            import uuid

            open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

    df = spark.range(64).select(
        F.col("id").cast("string").alias("record_id"), F.lit("a").alias("instruction"), F.array(F.lit("b")).alias("responses")
    )
    backend = WorkerBackend(Counted)
    for _ in range(2):
        score_responses(df.repartition(16), backend).collect()
    built = [name.split("-")[0] for name in os.listdir(folder)]
    assert built and len(built) == len(set(built))


def test_a_rewritten_instruction_is_answered_anew(pairs):
    for backend in (StandIn(), worker_backend()):
        for row in refine(pairs, backend, seed=7).filter("refined_instruction is not null").collect():
            assert row.refined_instruction.startswith(row.instruction)
            assert [r.startswith(row.refined_instruction) for r in row.refined_responses] == [True, True]
            assert row.refined_responses != row.responses and row.over_budget is False


def test_too_few_results_are_an_error():
    results = called(lambda items: [], ["a", "b"], 2, 1)
    assert [value for value, _ in results] == [None, None]
    assert all(error.startswith("ValueError") for _, error in results)


def test_threads_overlap_calls_up_to_their_number():
    running, most, lock = 0, 0, threading.Lock()

    def run(items):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.05)
        with lock:
            running -= 1
        return items

    called(run, list("abcdefghij"), 1, 4)
    assert most == 4


def test_missing_items_are_not_called():
    assert [v for v, _ in called(lambda x: x, ["a", None, "b"], 9, 1)] == ["a", None, "b"]


def test_a_slow_call_holds_up_no_later_batch():
    """One slow call in each batch: all other calls of the following batches are over before it is."""
    n, others, release, lock, order = worker.AHEAD, [], threading.Event(), threading.Lock(), []

    def ask(items):
        if "slow" in items[0]:
            # It ends only once the calls of the other batches have been made.
            assert release.wait(30)
        else:
            with lock:
                others.append(items[0])
                if len(others) == 3 * n:
                    release.set()
        return [(item.upper(), None) for item in items]

    batches = [(k, [f"{k} slow", f"{k}a", f"{k}b", f"{k}c"]) for k in range(n)]
    for batch, outcomes in _in_flight(iter(batches), ask, 1, n + 1, lambda item: -len(item)):
        order.append(batch)
        assert [v for v, _ in outcomes] == [item.upper() for item in batches[batch][1]]
    assert order == list(range(n)) and release.is_set()


def test_few_batches_are_held_and_calls_are_bounded():
    read, given, running, most, lock = 0, 0, 0, 0, threading.Lock()

    def batches():
        nonlocal read
        for k in range(40):
            read += 1
            assert read - given <= worker.AHEAD + 2
            yield k, ["x"] * 6

    def ask(items):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.002)
        with lock:
            running -= 1
        return [(item, None) for item in items]

    for k, outcomes in _in_flight(batches(), ask, 2, 3, len):
        assert k == given and len(outcomes) == 6
        given += 1
    assert given == 40 and most <= 3


def test_a_batch_without_items_keeps_its_place():
    found = [b for b, _ in _in_flight([(0, []), (1, ["a"]), (2, [None]), (3, [])], lambda some: [(i, None) for i in some], 4, 2, len)]
    assert found == [0, 1, 2, 3]


def test_only_open_items_are_asked_again_and_errors_end_them():
    asked = []

    def run(items, attempt):
        asked.append((attempt, list(items)))
        if "bad" in items:
            raise TimeoutError("slow")
        return [f"{item}{attempt}" for item in items]

    settled = lambda value: value in ("a1", "b3")
    outcomes = _until(run, ["a", "bad", "b", "c"], 3, settled)
    assert outcomes == [("a1", None), (None, "TimeoutError: slow"), ("b3", None), ("c3", None)]
    assert asked[0] == (1, ["a", "bad", "b", "c"]) and asked[-2:] == [(2, ["b", "c"]), (3, ["b", "c"])]


def test_a_model_that_does_not_count_attempts_is_asked_again(spark):
    class Improving(StandInModel):
        def __init__(self):
            self.seen = {}

        def complete(self, prompts):
            for prompt in prompts:
                self.seen[prompt] = self.seen.get(prompt, 0) + 1
            return ["no rubric" if self.seen[p] < 3 else super(Improving, self).complete([p])[0] for p in prompts]

    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "record_id string, instruction string").coalesce(1)
    for retries, n in ((2, 0), (3, 2)):
        report = rubric_report_live(df, WorkerBackend(Improving), max_retries=retries)
        assert report.count() == n
    failed = rubric_report_live(df, WorkerBackend(Improving), max_retries=1, keep_failed=True).collect()
    assert {r.failure_reason for r in failed} == {"invalid_instruction_or_feedback_parse_failed"}


def test_retries_in_the_workers_give_what_retries_in_the_plan_give(spark):
    docs = views.instructions(spark, SF_DIR)
    for keep in (False, True):
        live = lambda backend: rows(rubric_report_live(docs, backend, keep_failed=keep))  # noqa: E731, B023
        assert live(worker_backend(flaky=True, batch_size=5, threads=3)) == live(StandIn(flaky=True))
    assert plan_of(rubric_report_live(docs, worker_backend())).count("ArrowEvalPython") == 1


def test_a_text_is_readable_to_the_worker_when_the_columns_read_it(spark):
    texts = [r.feedback for r in views.rubric_texts(spark, SF_DIR).collect()]
    block = next(t for t in texts if readable(t))
    texts += [block.replace("- note", f"- {c}note") for c in ("\xa0", "\x1c", "\x85", "", "\u2028")] + [block.replace("* S", f"{c}* S") for c in ("\x0b", "\xa0", "\r")]
    texts += [block + "\n* Cl\u0301arity: 3/5 - x", block.replace("3/5", "\u0663/5"), "", None, block.replace(":", "\n:")]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    read = df.select("x", parse_rubric(F.col("x")).isNotNull().alias("ok")).collect()
    assert {r.ok for r in read} == {True, False}
    assert [r.ok for r in read] == [readable(r.x) for r in read]


def test_the_system_text_and_the_budget_reach_the_model(spark):
    class Echo(StandInModel):
        def generate(self, chats, n, seed, stops):
            return [[m["role"] + ":" + m["content"] for m in chat] for chat in chats]

    df = spark.createDataFrame([("1", "a b c d")], "record_id string, instruction string")
    row = generate_n(df, WorkerBackend(Echo), system="Be kind.", max_units=3).first()
    assert row.responses == ["system:Be kind.", "user:a b c"]
    assert row.instruction == "a b c d"


def test_flaky_attempts_all_occur(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("x"))
    backend = StandIn(flaky=True)
    x = F.col("x")
    replies = df.select(*[backend.critique(x, x, k).alias(f"r{k}") for k in (1, 2, 3)]).collect()
    first = [
        next((k for k in (1, 2, 3) if (r[f"r{k}"].text or "").startswith("Evaluation:")), None)
        for r in replies
    ]
    assert {1, 2, 3, None} == set(first)
    assert any(r.r1.error for r in replies) and not any(r.r2.error for r in replies)


@pytest.mark.parametrize("keep", ["head", "tail"])
@pytest.mark.parametrize("most", [0, 1, 3, 50])
def test_token_budgets(spark, keep, most):
    texts = ["", "a", "abcdefgh ij", "x\n\n\u00e9\u00e8 \U0001f600 1234567", None, "a b c d e f"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").coalesce(1)
    for backend in (StandIn(), worker_backend()):
        for row in token_budget(df, "x", backend, most, keep=keep).collect():
            if row.x is None:
                assert row.kept is None and row.over_budget is None
                continue
            tokens = re.findall(TOKEN, row.x)
            want = tokens[:most] if keep == "head" else tokens[max(0, len(tokens) - most) :]
            assert row.kept == "".join(want) and row.over_budget == (len(tokens) > most)


def test_token_budgets_of_scores_and_prompts(spark):
    df = spark.createDataFrame(
        [("1", "a b c d e f", ["x y", "z " * 9, None]), ("2", None, ["x"]), ("3", "a", None), ("4", "a b", [])],
        "record_id string, instruction string, responses array<string>",
    )
    model = StandInModel()
    for backend in (StandIn(), worker_backend()):
        found = {r.record_id: r for r in score_responses(df, backend, max_units=7, measure="tokens").collect()}
        want = model.score([("d e f"[1:], "x y"), ("", ("z " * 9)[-7:])])
        assert found["1"].scores == [*want, None] and found["1"].over_budget == [True, True, True]
        assert found["2"].scores is None and found["3"].scores is None and found["4"].scores == []
        row = generate_n(df, backend, max_units=3, measure="tokens").filter("record_id = '1'").first()
        assert row.responses[0].startswith("a b ") and row.over_budget
        with pytest.raises(ValueError, match="measure"):
            score_responses(df, backend, max_units=7, measure="words")


def test_equal_texts_are_encoded_once(spark):
    class Counted(StandInModel):
        def token_ends(self, texts):
            assert len(texts) == len(set(texts))
            return super().token_ends(texts)

    df = spark.createDataFrame([("same text", ["r", "r", "s"])] * 20, "instruction string, responses array<string>")
    assert score_responses(df, WorkerBackend(Counted), max_units=4, measure="tokens").count() == 20


def test_token_ends_are_asked_for_in_bounded_portions():
    asked = []

    class Noting(StandInModel):
        def token_ends(self, texts):
            asked.append(sum(map(len, texts)))
            return super().token_ends(texts)

    texts = [f"{k} " + "word " * 20_000 for k in range(40)] + ["x" * (2 * worker.PORTION)]
    cuts = worker._cuts_of(Noting(), {t: {0, 7} for t in texts}, "tail")
    assert len(asked) > 4 and sum(asked) == sum(map(len, texts))
    assert sum(n > worker.PORTION for n in asked) == 1  # the long text alone
    for t in texts:
        tokens = re.findall(TOKEN, t)
        assert cuts[t, 7] == {"n": len(tokens), "cut": len("".join(tokens[-7:]))} and cuts[t, 0]["cut"] == 0


def test_an_arrow_batch_becomes_python_objects_in_pieces():
    texts = pa.array([None if k % 10 == 0 else f"{k} " * 1000 for k in range(5000)])
    numbers = pa.array(range(5000))
    pieces = list(worker._pieces([(texts, numbers), (texts.slice(0, 0), numbers.slice(0, 0)), (texts.slice(0, 1), numbers.slice(0, 1))]))
    assert [t for piece, _ in pieces for t in piece] == [*texts.to_pylist(), None]
    assert [n for _, piece in pieces for n in piece] == [*range(5000), 0]
    assert max(sum(len(t or "") for t in piece) for piece, _ in pieces) < 2 * worker.PIECE_BYTES < texts.nbytes


def test_a_budgeted_score_takes_one_pass_over_the_texts(spark):
    df = spark.range(3).select(F.lit("a b c").alias("instruction"), F.array(F.lit("d e")).alias("responses"))
    plan = plan_of(score_responses(df, worker_backend(), max_units=4, measure="tokens"))
    assert plan.count("ArrowEvalPython") == 1


def test_a_score_without_a_number_is_null_within_a_budget(spark):
    class Broken(StandInModel):
        def score(self, pairs):
            if any(r == "bad" for _, r in pairs):
                raise ValueError("no")
            return [float("nan") if r == "nan" else 0.5 for _, r in pairs]

    df = spark.createDataFrame([("a b", ["x", "bad", "nan", None])], "instruction string, responses array<string>")
    (row,) = score_responses(df, WorkerBackend(Broken), max_units=50, measure="tokens").collect()
    (old,) = score_responses(df, WorkerBackend(Broken)).collect()
    assert row.scores == old.scores == [0.5, None, None, None] and row.over_budget == [False] * 4
