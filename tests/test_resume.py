import pytest
from helpers import run_plan_of
from pyspark.sql import functions as F

from prefspark.backends.standin import StandIn
from prefspark.operators.resume import align_outputs, cache_hits, cache_lookup, skip_done
from prefspark.plans.preparation import first_responses
from prefspark.schemas import CACHE
from prefspark.sources.tables import read_cache


def rows(spark, *texts):
    return spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(texts)], "record_id string, instruction string"
    )


def logged(record_id, text, refined, number=0):
    return (record_id, text, ["r"], "f", f"o-{record_id}", ["or"], refined, ["rr"], number)


def test_skip_done_keeps_repeats(spark):
    df = rows(spark, "a", "b", "b", "", None, " ", "c")
    done = rows(spark, "c", "c", None)
    assert sorted(r.instruction for r in skip_done(df, done).collect()) == [" ", "a", "b", "b"]
    assert skip_done(df, done, dedupe=True).count() == 3
    assert skip_done(df, rows(spark, None)).count() == 5


def test_first_logged_row_wins(spark):
    cache = spark.createDataFrame(
        [
            logged("3", "a", "later round", 1),
            logged("2", "a", "second"),
            logged("1", "a", "first"),
            logged("9", "b", "other"),
            logged("0", None, "none"),
        ],
        CACHE,
    )
    df = rows(spark, "a", "x", "a", None, "")
    got = {r.record_id: r.hit for r in cache_lookup(df, cache).collect()}
    assert len(got) == 5 and got["1"] is got["3"] is got["4"] is None
    assert got["0"] == got["2"] and got["0"].refined_instruction == "first"
    assert got["0"].original_instruction == "o-1" and got["0"].feedback == "f"
    assert {r.record_id for r in cache_hits(df, cache).collect()} == {"0", "2"}


def test_outputs_are_matched_by_id(spark):
    inputs = rows(spark, "a", "b", "c")
    outputs = spark.createDataFrame([("2", "C"), ("0", "A")], "record_id string, out string")
    got = {r.instruction: r.out for r in align_outputs(inputs, outputs).collect()}
    assert got == {"a": "A", "b": None, "c": "C"}


@pytest.fixture
def skewed(spark, tmp_path):
    """A third of the rows share one instruction."""
    text = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id")))
    path = str(tmp_path / "skewed")
    spark.range(0, 30_000, 1, 16).select(
        F.col("id").cast("string").alias("record_id"),
        text.alias("instruction"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("join", ["skip_done", "cache_lookup", "cache_hits"])
def test_a_hot_instruction_is_split(spark, conf, skewed, join):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    known = skewed.filter("record_id = '0' or record_id like '%1'")
    n_known = known.select("instruction").distinct().count() - 1
    if join == "skip_done":
        df = skip_done(skewed, known)
        expected = 20_000 - n_known
    else:
        cache = known.select(
            "record_id",
            "instruction",
            F.array().cast("array<string>").alias("responses"),
            F.lit("f").alias("feedback"),
            F.col("instruction").alias("original_instruction"),
            F.array().cast("array<string>").alias("original_responses"),
            F.lit("r").alias("refined_instruction"),
            F.array().cast("array<string>").alias("refined_responses"),
            F.lit(0).alias("round"),
        )
        df = cache_lookup(skewed, cache) if join == "cache_lookup" else cache_hits(skewed, cache)
        expected = 30_000 if join == "cache_lookup" else 10_000 + n_known
    assert "skew=true" in run_plan_of(df)
    assert df.count() == expected


def test_small_right_sides_are_broadcast_by_size(spark, skewed):
    plan = run_plan_of(skip_done(skewed, rows(spark, "hot")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


def test_failed_rows_are_answered_on_the_next_run(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "record_id string, instruction string")
    earlier = spark.createDataFrame(
        [("1", "a", ["x"], None), ("2", "b", None, "TimeoutError: t"), ("3", "c", None, None)],
        "record_id string, instruction string, responses array<string>, error string",
    )
    path = str(tmp_path / "earlier")
    earlier.write.parquet(path)
    done = spark.read.parquet(path)
    assert sorted(r.record_id for r in first_responses(rows, StandIn(), done=done).collect()) == ["2", "3"]
    everything = first_responses(rows, StandIn(), done=done).unionByName(done.filter("error is null and responses is not null"), allowMissingColumns=True)
    assert skip_done(rows, everything).isEmpty()


def test_one_blank_line_does_not_void_a_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    spark.createDataFrame([('{"record_id": "1", "instruction": "a", "round": 0}',), ("\t",), (" ",)], "value string").coalesce(1).write.text(path)
    assert [r.instruction for r in read_cache(spark, path).collect()] == ["a"]
