import collections
import hashlib
import json
import os
import shutil
import sys

import pytest
from helpers import TESTDATA, ByLength, run_plan_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from prefspark.backends.standin import StandIn
from prefspark.backends.worker import WorkerBackend
from prefspark.catalog import views
from prefspark.catalog.standin_model import StandInModel
from prefspark.constants import ACCEPTED
from prefspark.functions.scores import collapse
from prefspark.operators.resume import first_logged
from prefspark.operators.routing import route_counts
from prefspark.plans.finalize import finalize
from prefspark.plans.preparation import first_responses, sample_instructions
from prefspark.plans.rounds import Run, conservation, refine_rounds, score_and_route
from prefspark.schemas import CACHE, PAIRS
from prefspark.sources import tables
from prefspark.sources.imports import import_instructions

SF_DIR = f"{TESTDATA}/sf0.01"

# The workers cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def counts(run):
    return {(r["round"], r.route): r.n for r in run.counts.collect()}


def pair(record_id, instruction, *responses):
    return (record_id, instruction, list(responses))


@pytest.fixture(scope="module")
def pairs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pairs"))
    views.pairs(spark, SF_DIR).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("gamma", [0.3, 0.6, 0.9])
def test_known_counts(spark, pairs, gamma):
    """Against the rounds in plain Python, one row at a time."""
    model, ends = StandInModel(), {}
    for row in pairs.collect():
        text, answers = row.instruction, row.responses[:2]
        for number in range(3):
            scores = model.score([(text, answer) for answer in answers])
            if not scores or min(scores) >= gamma:
                ends[row.record_id] = ("accepted", number, text, answers) if scores else ("invalid", number, text, answers)
                break
            text = f"{text} {hashlib.md5(text.encode()).hexdigest()}"
            answers = model.generate([[{"content": text}]], 2, 42, ())[0]
        else:
            ends[row.record_id] = ("left", None, text, answers)
    run = refine_rounds(spark, pairs, StandIn(), gamma=gamma)
    got = {r.record_id: ("accepted", r["round"], r.instruction, r.responses) for r in run.accepted.collect()}
    got |= {r.record_id: ("left", None, r.instruction, r.responses) for r in run.left.collect()}
    got |= {r.record_id: ("invalid", r["round"], r.instruction, r.responses) for r in run.invalid.collect()}
    assert got == ends
    kinds = [end[0] for end in ends.values()]
    assert kinds.count("invalid") == 2 and {"accepted", "left"} <= set(kinds)
    assert tuple(conservation(pairs, run).first()) == (100, kinds.count("accepted"), kinds.count("left"), 2, True)


def test_lineage_stays_with_the_first_round(spark):
    text = "abcdefgh" * 4
    df = spark.createDataFrame([pair("1", text, "xy" * 20, "z" * 20)], PAIRS)
    run = refine_rounds(spark, df, ByLength(), gamma=0.7)
    log = sorted(run.refine_log.collect(), key=lambda r: r["round"])
    assert [r.instruction for r in log] == [text, text[:16], text[:8]]
    assert [r.refined_instruction for r in log] == [text[:16], text[:8], text[:4]]
    assert [r.refined_responses for r in log] == [[text[:16] * 2] * 2, [text[:8] * 2] * 2, [text[:4] * 2] * 2]
    assert [r.responses for r in log][1:] == [r.refined_responses for r in log][:-1]
    assert {r.original_instruction for r in log} == {text}
    final = {(r.side, r.status): r.instruction for r in run.final_products.collect()}
    assert final == {("original", "left"): text, ("refined", "left"): text[:4]}


def test_rows_accepted_at_once_are_on_both_sides(spark):
    df = spark.createDataFrame([pair("1", "ab", "x" * 50)], PAIRS)
    run = refine_rounds(spark, df, ByLength(), gamma=0.5)
    assert run.rounds_done == 1 and run.left.isEmpty()
    assert rows(run.final_products.select("side", "instruction", "status")) == [
        ("original", "ab", "accepted"),
        ("refined", "ab", "accepted"),
    ]


def test_stops_early_once_nothing_goes_on(spark):
    df = spark.createDataFrame([pair("1", "a" * 40, "x" * 30), pair("2", "a", "x" * 30)], PAIRS)
    run = refine_rounds(spark, df, ByLength(), gamma=0.5, max_rounds=9)
    assert run.rounds_done == 2
    assert counts(run) == {(0, "accepted"): 1, (0, "refine"): 1, (1, "accepted"): 1}


def test_no_rows(spark):
    run = refine_rounds(spark, spark.createDataFrame([], PAIRS), ByLength(), gamma=0.5)
    assert run.rounds_done == 1 and run.final_products.isEmpty()


def test_extra_responses_are_dropped_before_scoring(spark):
    df = spark.createDataFrame([pair("1", "ab", "x" * 50, "y" * 50, "z")], PAIRS)
    run = refine_rounds(spark, df, ByLength(), gamma=0.5)
    assert run.accepted.first().responses == ["x" * 50, "y" * 50]


def test_bad_arguments(spark, pairs):
    with pytest.raises(ValueError, match="aggregate"):
        refine_rounds(spark, pairs, StandIn(), gamma=0.5, agg="median")
    with pytest.raises(ValueError, match="max_rounds"):
        refine_rounds(spark, pairs, StandIn(), gamma=0.5, max_rounds=0)
    with pytest.raises(TypeError):
        refine_rounds(spark, pairs, StandIn())


def cache_of(spark, *entries):
    return spark.createDataFrame(
        [
            (record_id, text, ["cr"], "cached feedback", "co", ["cor"], refined, ["x" * 99], number)
            for record_id, text, refined, number in entries
        ],
        CACHE,
    )


def test_cache_goes_first(spark):
    cache = cache_of(spark, ("8", "hit", "late", 1), ("9", "hit", "early", 0), ("7", "early", "deep", 0))
    df = spark.createDataFrame(
        [
            pair("1", "hit", "x" * 99),
            pair("2", "hit"),
            pair("3", "miss", "x" * 99),
            pair("4", "miss " * 99, "x"),
        ],
        PAIRS,
    )
    run = refine_rounds(spark, df, ByLength(), gamma=0.5, cache=cache, max_rounds=2)
    routed = {(r.record_id, r["round"]): (r.route, r.scores) for r in run.routed.collect()}
    assert routed["1", 0] == routed["2", 0] == ("cached", None)
    assert routed["3", 0][0] == "accepted" and routed["4", 0][0] == "refine"
    # What the cache gave is looked up again in the next round.
    assert routed["1", 1] == ("cached", None)
    left = {r.record_id: r for r in run.left.collect()}
    assert left["1"].instruction == "deep" and left["1"].original_instruction == "co"
    assert {r.instruction for r in run.next_round(0).collect()} >= {"early"}
    log = {(r.record_id, r["round"]): r for r in run.refine_log.collect()}
    assert log["1", 0].from_cache and log["1", 0].feedback == "cached feedback"
    assert log["1", 0].responses == ["cr"] and not log["4", 0].from_cache
    assert conservation(df, run).first().whole


def test_cached_rows_are_not_sent_to_the_model(spark):
    class Refusing(StandInModel):
        def score(self, pairs):
            assert all(text != "hit" for text, _ in pairs)
            return [len(r) / (len(r) + len(text)) for text, r in pairs]

    df = spark.createDataFrame([pair("1", "hit", "x"), pair("2", "miss", "x" * 99)], PAIRS)
    hits = first_logged(cache_of(spark, ("8", "hit", "r", 0)))
    routed = score_and_route(df, WorkerBackend(Refusing), gamma=0.5, first_logged=hits)
    assert {r.record_id: r.route for r in routed.collect()} == {"1": "cached", "2": "accepted"}


def test_a_failed_refinement_keeps_its_row(spark):
    class NoRewrite(StandInModel):
        def complete(self, prompts):
            if any("stuck" in prompt for prompt in prompts):
                raise TimeoutError("slow")
            return super().complete(prompts)

    df = spark.createDataFrame([pair("1", "stuck " * 9, "x"), pair("2", "free " * 9, "x")], PAIRS)
    run = refine_rounds(spark, df, WorkerBackend(NoRewrite), gamma=1.0, max_rounds=2)
    left = {r.record_id: r for r in run.left.collect()}
    assert left["1"].instruction == "stuck " * 9 and left["1"].responses == ["x"]
    assert left["2"].instruction != "free " * 9
    errors = run.refine_log.filter("error is not null")
    assert rows(errors.select("record_id", "round", "error")) == [
        ("1", 0, "TimeoutError: slow"),
        ("1", 1, "TimeoutError: slow"),
    ]


class OncePerRow(StandInModel):
    """Scores at random: a score computed twice would differ."""

    def score(self, pairs):
        import random

        return [random.random() for _ in pairs]


def test_random_scores_lose_no_row(spark, pairs):
    run = refine_rounds(spark, pairs, WorkerBackend(OncePerRow), gamma=0.6)
    assert conservation(pairs, run).first().whole
    for row in run.routed.filter(F.size("responses") > 0).collect():
        assert (min(row.scores) >= 0.6) == (row.route == ACCEPTED)


def files(root):
    return {
        os.path.join(folder, name): os.path.getmtime(os.path.join(folder, name))
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    }


def test_rerunning_replaces_the_run(spark, pairs, tmp_path):
    workdir = str(tmp_path / "run")
    first = rows(refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir).final_products)
    again = refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir)
    assert rows(again.final_products) == first
    # A shorter run leaves nothing of the longer one behind.
    short = refine_rounds(spark, pairs, StandIn(), gamma=0.0, workdir=workdir)
    assert short.rounds_done == 1
    assert not os.path.exists(f"{workdir}/routed/round=1")


def test_resuming_keeps_what_is_complete(spark, pairs, tmp_path):
    workdir = str(tmp_path / "run")
    options = dict(gamma=0.9, workdir=workdir, cache=cache_of(spark, ("1", "none", "r", 0)))
    whole = rows(refine_rounds(spark, pairs, StandIn(), **options).final_products)
    # As if the run had been interrupted while it wrote the log of its second round.
    for round_dir in ("refine_log/round=1/part=0", "routed/round=2/part=0"):
        os.rename(f"{workdir}/{round_dir}/_SUCCESS", f"{workdir}/{round_dir}/_lost")
    before = files(workdir)
    run = refine_rounds(spark, pairs, StandIn(), **options, resume=True)
    assert rows(run.final_products) == whole
    kept = {path for path, time in files(workdir).items() if before.get(path) == time}
    assert {p.split("part-")[0][len(workdir) :].split("/route=")[0].strip("/") for p in kept} == {
        "cache", "routed/round=0/part=0", "refine_log/round=0/part=0", "routed/round=1/part=0",
    }
    with pytest.raises(ValueError, match="other settings"):
        refine_rounds(spark, pairs, StandIn(), gamma=0.8, workdir=workdir, resume=True)


def test_resuming_can_add_rounds(spark, pairs, tmp_path):
    workdir = str(tmp_path / "run")
    refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir, max_rounds=1)
    more = refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir, resume=True)
    fresh = refine_rounds(spark, pairs, StandIn(), gamma=0.9)
    assert rows(more.final_products) == rows(fresh.final_products)


def test_resuming_with_other_responses_is_an_error(spark, pairs, tmp_path):
    workdir = str(tmp_path / "run")
    refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir, max_rounds=1)
    other = pairs.withColumn("responses", F.reverse("responses"))
    with pytest.raises(ValueError, match="other settings"):
        refine_rounds(spark, other, StandIn(), gamma=0.9, workdir=workdir, max_rounds=1, resume=True)


@pytest.mark.parametrize("parts", [2, 7])
def test_parts_do_not_change_the_run(spark, pairs, parts):
    whole = refine_rounds(spark, pairs, StandIn(), gamma=0.6)
    dealt = refine_rounds(spark, pairs, StandIn(), gamma=0.6, parts=parts)
    assert rows(dealt.final_products) == rows(whole.final_products) and counts(dealt) == counts(whole)
    assert dealt.rounds_done == whole.rounds_done and conservation(pairs, dealt).first().whole
    with pytest.raises(ValueError):
        refine_rounds(spark, pairs, StandIn(), gamma=0.6, parts=0)


@pytest.mark.parametrize("parts", [1, 3])
def test_counts_taken_while_writing_are_those_of_the_tables(spark, pairs, tmp_path, parts):
    workdir = str(tmp_path / "run")
    options = dict(gamma=0.6, parts=parts, workdir=workdir, cache=cache_of(spark, ("1", "none", "r", 0)))
    run = refine_rounds(spark, pairs, StandIn(), **options)
    want = {(r["round"], r.route): r.n for r in route_counts(run.routed, "round").collect()}
    assert counts(run) == want and len(want) > 4
    # A restart counts the rows that it keeps.
    os.rename(f"{workdir}/refine_log/round=1/part=0/_SUCCESS", f"{workdir}/refine_log/round=1/part=0/_lost")
    shutil.rmtree(f"{workdir}/counts")
    again = refine_rounds(spark, pairs, StandIn(), **options, resume=True)
    assert counts(again) == want
    # Without the notes the tables are counted.
    shutil.rmtree(f"{workdir}/counts")
    assert counts(again) == want


def test_an_empty_run_stops(spark, pairs):
    run = refine_rounds(spark, pairs.limit(0), StandIn(), gamma=0.6)
    assert run.rounds_done == 1 and counts(run) == {}


class Counting(StandInModel):
    """Notes the pairs it scores, and takes its whole process down when it meets one of them."""

    def __init__(self, folder):
        self.folder = folder

    def score(self, pairs):
        import uuid

        broken = os.path.join(self.folder, "broken")
        if os.path.exists(broken) and open(broken).read() in [text for text, _ in pairs]:
            os._exit(1)
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as file:
            file.write("\n".join(hashlib.md5(f"{a}|{b}".encode()).hexdigest() for a, b in pairs))
        return super().score(pairs)


def scored(folder):
    """How often each pair was scored."""
    found = collections.Counter()
    for name in os.listdir(folder):
        if name != "broken":
            found.update(open(os.path.join(folder, name)).read().split())
    return found


def test_a_killed_round_is_resumed_by_its_parts(spark, pairs, tmp_path):
    workdir, parts = str(tmp_path / "run"), 5
    calls = tmp_path / "calls"
    calls.mkdir()
    options = dict(gamma=0.5, max_rounds=2, parts=parts, workdir=workdir)
    backend = WorkerBackend(lambda: Counting(str(calls)), name="counting", batch_size=1)
    part = F.pmod(F.xxhash64(F.col("record_id").cast("string"), "instruction"), F.lit(parts))
    with_answers = pairs.filter(F.size("responses") > 0)
    # The last row of the fourth part takes the job down, half way through the first round.
    fatal = with_answers.filter(part == 3).orderBy(F.desc("record_id")).first().instruction
    (calls / "broken").write_text(fatal)
    with pytest.raises(Exception):
        refine_rounds(spark, pairs, backend, **options)
    assert [os.path.exists(f"{workdir}/refine_log/round=0/part={k}/_SUCCESS") for k in range(parts)] == [True] * 3 + [False] * 2
    (calls / "broken").unlink()
    finished = with_answers.filter(part < 3).select("instruction", F.explode(F.slice("responses", 1, 2)).alias("r")).collect()
    run = refine_rounds(spark, pairs, backend, **options, resume=True)
    assert rows(run.final_products) == rows(refine_rounds(spark, pairs, StandIn(), gamma=0.5, max_rounds=2).final_products)
    often = scored(str(calls))
    # What was committed is not asked again.
    done = {hashlib.md5(f"{r.instruction}|{r.r}".encode()).hexdigest() for r in finished}
    assert done and all(often[key] == 1 for key in done)


def test_scoring_budgets_in_rounds(spark):
    long, words = " ".join(f"w{k}" for k in range(6000)), lambda n: " ".join(f"r{k}" for k in range(n))
    data = [pair("1", long, words(10), words(5000)), pair("2", "short", "a b", words(4096)), pair("3", "", words(4097)), pair("4", None, "x"), pair("5", long)]
    df = spark.createDataFrame(data, PAIRS)
    run = refine_rounds(spark, df, StandIn(), gamma=0.5, max_rounds=1, score_units=4096)
    model = StandInModel()
    found = {r.record_id: r for r in run.routed.collect()}
    tail = lambda text, n: " ".join(text.split()[-n:]) if n else ""
    asked = [(tail(long, 4086), words(10)), ("", tail(words(5000), 4096)), ("short", "a b"), ("", words(4096)), ("", tail(words(4097), 4096))]
    want = model.score(asked)
    assert found["1"].scores == want[:2] and found["1"].score_over_budget == [True, True]
    assert found["2"].scores == want[2:4] and found["2"].score_over_budget == [False, True]
    assert found["3"].scores == want[4:] and found["3"].score_over_budget == [True]
    assert found["4"].route == found["5"].route == "invalid" and found["5"].score_over_budget == []
    worker = refine_rounds(spark, df, WorkerBackend(StandInModel), gamma=0.5, max_rounds=1, score_units=4096)
    assert rows(worker.routed.select("record_id", "scores", "score_over_budget", "route")) == rows(
        run.routed.select("record_id", "scores", "score_over_budget", "route")
    )
    none = refine_rounds(spark, df, StandIn(), gamma=0.5, max_rounds=1)
    assert {r.score_over_budget for r in none.routed.collect()} == {None}


def test_rounds_with_budgets_in_tokens(spark, pairs, tmp_path):
    options = dict(gamma=0.5, max_rounds=2, max_units=12, score_units=30, measure="tokens")
    runs = [refine_rounds(spark, pairs, b, **options) for b in (StandIn(), WorkerBackend(StandInModel, name="stand-in"))]
    assert rows(runs[0].routed) == rows(runs[1].routed) and rows(runs[0].refine_log) == rows(runs[1].refine_log)
    assert any(any(r.score_over_budget or []) for r in runs[0].routed.collect())
    assert {r.over_budget for r in runs[0].refine_log.collect()} == {True}
    workdir = str(tmp_path / "run")
    refine_rounds(spark, pairs, StandIn(), workdir=workdir, **options)
    with pytest.raises(ValueError, match="other settings"):
        refine_rounds(spark, pairs, StandIn(), workdir=workdir, resume=True, **options | {"measure": "units"})


def test_a_run_is_not_resumed_with_another_scoring_budget(spark, pairs, tmp_path):
    workdir = str(tmp_path / "run")
    refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir, max_rounds=1, score_units=50)
    for other in (51, None):
        with pytest.raises(ValueError, match="other settings"):
            refine_rounds(spark, pairs, StandIn(), gamma=0.9, workdir=workdir, max_rounds=1, score_units=other, resume=True)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_finalize_writes_four_datasets(spark, pairs, tmp_path, fmt):
    run = refine_rounds(spark, pairs, StandIn(), gamma=0.4)
    path = str(tmp_path / "final")
    for _ in range(2):
        products = finalize(spark, run.workdir, run.rounds_done, path, fmt)
    assert rows(products.select(*run.final_products.columns)) == rows(run.final_products)
    for side in ("original", "refined"):
        for status, n in (("accepted", run.accepted.count()), ("left", run.left.count())):
            folder = f"{path}/side={side}/status={status}"
            assert spark.read.schema(PAIRS).format(fmt).load(folder).count() == n
    with pytest.raises(ValueError):
        Run(spark, run.workdir, 0).left


def test_final_files_are_in_the_order_of_the_input(spark, tmp_path):
    """From numbered lines through a sample, first responses and rounds to files in input order."""
    lines = str(tmp_path / "in.jsonl")
    with open(lines, "w") as file:
        file.writelines(json.dumps({"instruction": f"text {k} " * (1 + k % 9)}) + "\n" for k in range(300))
    data = import_instructions(spark, spark.read.schema("instruction string").json(lines), str(tmp_path / "data"))
    first = first_responses(sample_instructions(data, 0.5), StandIn())
    assert "seq" in first.columns
    run = refine_rounds(spark, first, StandIn(), gamma=0.5, parts=3, cache=cache_of(spark, ("1", "none", "r", 0)))
    path = str(tmp_path / "final")
    assert finalize(spark, run.workdir, run.rounds_done, path, "json", in_order=True).count() == 300
    found = set()
    for folder, _, names in os.walk(path):
        rows = [json.loads(line) for name in sorted(names) if name.endswith(".json") for line in open(os.path.join(folder, name))]
        assert [r["seq"] for r in rows] == sorted(r["seq"] for r in rows)
        found |= {r["seq"] for r in rows}
    assert len(found) == 150 and all(r.instruction == f"text {r.seq} " * (1 + r.seq % 9) for r in run.routed.filter("round = 0").collect())


def test_fewer_rounds_can_be_finalized(spark, pairs):
    run = refine_rounds(spark, pairs, StandIn(), gamma=0.4)
    earlier = Run(spark, run.workdir, 1)
    assert earlier.accepted.count() + earlier.left.count() == 98
    assert 0 < earlier.accepted.count() < run.accepted.count()


def test_from_dataset_to_products(spark, tmp_path):
    documents = views.documents(spark, SF_DIR)
    sample = sample_instructions(documents, 0.1)
    assert sample.count() == 100
    done = sample.limit(10)
    first = first_responses(sample, StandIn(), done=done)
    path = str(tmp_path / "first")
    first.write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() <= 90 and stored.filter(F.size("responses") != 2).isEmpty()
    run = refine_rounds(spark, stored, StandIn(), gamma=0.1, max_rounds=2)
    out = str(tmp_path / "final")
    tables.write_jsonl(run.final_products, out, order_by="record_id")
    assert spark.read.json(out).count() == 2 * stored.count()


def test_long_conversations_are_cut_before_the_shuffle(spark):
    plan = run_plan_of(views.pairs(spark, SF_DIR))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits) and any("Final" in line for line in limits)
