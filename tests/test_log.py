"""The log of a run, read record by record."""

import os
import random

import pytest
from helpers import TESTDATA
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.backends.standin import StandIn
from prefspark.catalog import views
from prefspark.catalog.queries import QUERIES
from prefspark.functions.wrapping import EARLIER, packed_earlier, packed_schema, unpacked, unpacked_earlier
from prefspark.operators.inference import generate_n
from prefspark.operators.resume import first_logged, met
from prefspark.plans.rounds import refine_rounds
from prefspark.schemas import CACHE, LOGGED, NEXT_ROUND, PAIRS, REFINE_LOG, STORED_LOG
from prefspark.session import CHECKPOINT_DIR
from prefspark.sources.tables import read_rounds


def rows(df):
    return sorted(map(repr, df.collect()))


def round_by_round(run):
    """The log as the tables of the rounds hold it."""
    stored = read_rounds(run.spark, f"{run.workdir}/refine_log", STORED_LOG, run.rounds_done)
    return unpacked(stored).select(*REFINE_LOG.fieldNames())


def test_earlier_rows_come_back_as_they_were(spark):
    draw = random.Random(1)
    texts = [None, "", "a", "ab", "abc", "é", "éa", "[1] ab", "ab \U0001f600"]
    one = lambda: draw.choice(texts)
    some = lambda: draw.choice([None, [], [one()], [one(), one()], [one(), one(), one()]])
    row = lambda: (one(), some(), one(), one(), some(), one(), some(), one(), draw.choice([None, True]), False)
    schema = T.StructType([*NEXT_ROUND.fields, T.StructField(EARLIER, T.ArrayType(LOGGED))])
    earlier = lambda: draw.choice([None, [], [row()], [row(), row()], [row(), row(), row()]])
    df = spark.createDataFrame([(str(i), one(), some(), one(), some(), i, earlier()) for i in range(2000)], schema)
    small = packed_earlier(df)
    assert small.schema[EARLIER].dataType.simpleString() == packed_schema(schema)[EARLIER].dataType.simpleString()
    assert rows(small.withColumn(EARLIER, unpacked_earlier(small))) == rows(df)


@pytest.mark.parametrize("parts", [1, 3])
def test_the_log_by_records_has_the_rows_of_the_rounds(spark, parts):
    pairs = [(str(i), f"text {i} " * (i % 7), ["y", f"text {i} x", "z"][: i % 4]) for i in range(60)]
    # Records that share an id or have none, and rows that are equal in everything.
    pairs += [(None, "hit", ["x"]), (None, None, ["x"]), ("1", "hit", ["x"]), ("1", "text 1 ", ["x"]), ("1", "hit", None)] * 2
    pairs = spark.createDataFrame(pairs, PAIRS)
    again = F.md5(F.lit("text 1 ")).alias("again")
    rewritten = "text 1  " + spark.range(1).select(again).first().again
    cache = spark.createDataFrame(
        [
            ("8", "hit", ["cr", None, "x", "hit x"], "f", None, None, "deep", ["x" * 9, "hit", "deep y"], 0),
            ("9", rewritten, None, None, "co", ["cor"], None, None, 0),
        ],
        CACHE,
    )
    run = refine_rounds(spark, pairs, StandIn(), gamma=0.7, cache=cache, parts=parts)
    want = rows(round_by_round(run))
    assert run.refine_log.dtypes == [(f.name, f.dataType.simpleString()) for f in REFINE_LOG.fields]
    assert rows(run.refine_log) == want
    kinds = {(r["round"], r.from_cache) for r in run.refine_log.collect()}
    # The cache is met in later rounds, too.
    assert {(0, True), (0, False), (1, True), (2, False)} <= kinds
    run.drop_all_but_log()
    assert rows(run.refine_log) == want


def test_a_run_without_a_log(spark):
    pairs = spark.createDataFrame([("1", "a", ["b"])], PAIRS)
    run = refine_rounds(spark, pairs, StandIn(), gamma=0.0)
    assert run.rounds_done == 1 and run.refine_log.collect() == []


def size(folder):
    return sum(os.path.getsize(f"{at}/{name}") for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet"))


def test_files_hold_the_rows_of_a_record_together(spark, tmp_path):
    """Three rounds of a record, written by themselves, take little more than one."""
    docs = views.instructions(spark, f"{TESTDATA}/sf0.001").filter("length(instruction) < 10000")
    pairs = generate_n(docs, StandIn())
    run = refine_rounds(spark, pairs, StandIn(), gamma=1.0, workdir=str(tmp_path / "run"))
    run.refine_log.write.option("compression", "snappy").parquet(str(tmp_path / "log"))
    round_by_round(run).write.option("compression", "snappy").parquet(str(tmp_path / "rounds"))
    assert size(tmp_path / "log") < 0.7 * size(tmp_path / "rounds")


def test_refine_log_keeps_no_other_tables(spark):
    kept = spark.conf.get(CHECKPOINT_DIR)
    before = set(os.listdir(kept))
    log = QUERIES["refine_log"](spark, f"{TESTDATA}/sf0.001")
    (work,) = set(os.listdir(kept)) - before
    found = {at[len(f"{kept}/{work}/") :] for at, _, names in os.walk(f"{kept}/{work}") if any(n.endswith(".parquet") for n in names)}
    routes = {f"routed/round={k}/part=0/route=accepted" for k in (1, 2)}
    assert found <= routes | {"refine_log/round=2/part=0"} and log.count()


def test_of_the_cache_only_what_rows_meet(spark):
    cache = spark.createDataFrame([(str(k), f"t{k}", ["r"], "f", "o", ["r"], "n", ["r"], 0) for k in range(9)], CACHE)
    df = spark.createDataFrame([("1", "t3", ["x"]), ("2", "t3", None), ("3", None, None), ("4", "u", ["x"])], PAIRS)
    first = first_logged(cache)
    found = met(first, df)
    assert found.schema == first.schema and found.count() == 1
