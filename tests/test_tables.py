import json
import os

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from prefspark.operators.ordinals import in_input_order, numbered, running_sum
from prefspark.operators.reports import text_field
from prefspark.operators.resume import cache_lookup, drop_empty
from prefspark.plans.preparation import project_instruction
from prefspark.schemas import CACHE, INSTRUCTION, PAIRS
from prefspark.session import CHECKPOINT_DIR, WAREHOUSE_DIR, new_workdir, shared_dir
from prefspark.sources import tables
from prefspark.sources.imports import import_instructions


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_strict_read(spark, tmp_path):
    path = write(
        tmp_path / "in.jsonl", '{"record_id":"1","instruction":"a"}', "", "   ", '{"record_id":"2"}'
    )
    rows = {tuple(r) for r in tables.read_jsonl(spark, path, INSTRUCTION).collect()}
    assert rows == {("1", "a"), ("2", None)}
    bad = write(tmp_path / "bad.jsonl", '{"instruction":"a"}', "{bad")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_jsonl(spark, bad, INSTRUCTION).collect()


def test_absent_keys_read_as_null(spark, tmp_path):
    path = write(tmp_path / "in.jsonl", '{"instruction":"a","responses":["x","y"],"other":1}')
    assert tables.read_jsonl(spark, path, PAIRS).collect() == [(None, "a", ["x", "y"])]


def test_tolerant_read(spark, tmp_path):
    path = write(tmp_path / "done.jsonl", '{"instruction":"a"}', "{bad", "", '{"instruction":"b"}')
    assert {r.instruction for r in tables.read_done(spark, path).collect()} == {"a", "b"}
    assert tables.read_done(spark, str(tmp_path / "none")).count() == 0


def test_cache_read(spark, tmp_path):
    row = {"instruction": "a", "responses": ["x"], "refined_instruction": "b", "round": 1}
    path = write(tmp_path / "cache.jsonl", json.dumps(row))
    cache = tables.read_cache(spark, path)
    assert cache.schema == CACHE and cache.first().refined_instruction == "b"
    for other in (write(tmp_path / "bad.jsonl", json.dumps(row), "{bad"), str(tmp_path / "none")):
        empty = tables.read_cache(spark, other)
        assert empty.schema == CACHE and empty.isEmpty()


def test_write_keeps_text_and_order(spark, tmp_path):
    path = str(tmp_path / "out")
    texts = ["é", '"q"', "日本", "a\nb"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, instruction string")
    tables.write_jsonl(df.repartition(4), path, order_by="seq")
    tables.write_jsonl(df.repartition(4), path, order_by="seq")  # replaces, does not append
    lines = [
        line
        for name in sorted(os.listdir(path))
        if name.endswith(".json")
        for line in open(os.path.join(path, name), encoding="utf-8").read().splitlines()
    ]
    assert [json.loads(line)["instruction"] for line in lines] == texts
    assert "é" in lines[0] and "\\u" not in "".join(lines)


def test_rounds_are_replaced_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "record_id string, route string")
    schema = "record_id string, round int, route string"
    schema = spark.createDataFrame([], schema).schema
    tables.write_round(rows, root, 0, partition_by="route")
    tables.write_round(rows, root, 1, partition_by="route")
    tables.write_round(rows.filter("route = 'a'"), root, 0, partition_by="route")
    got = {tuple(r) for r in tables.read_rounds(spark, root, schema).collect()}
    assert got == {("1", 0, "a"), ("1", 1, "a"), ("2", 1, "b")}
    assert tables.read_rounds(spark, root, schema, 1).count() == 1
    assert tables.read_round(spark, root, schema, 1).count() == 2
    assert tables.round_is_complete(spark, root, 1)
    assert not tables.round_is_complete(spark, root, 2)
    assert tables.read_rounds(spark, str(tmp_path / "none"), schema).isEmpty()


def test_route_partitions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "record_id string, route string")
    tables.write_round(rows, root, 0, partition_by="route")
    schema = spark.createDataFrame([], "record_id string, round int, route string").schema
    kept = tables.read_rounds(spark, root, schema, 1).filter("route = 'a'")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(route" in plan.split("PartitionFilters")[1]


def test_imported_ids_are_unique_and_stay(spark, tmp_path):
    lines = spark.range(100).select(F.concat(F.lit("t"), F.col("id")).alias("instruction"))
    stored = import_instructions(spark, lines.repartition(5), str(tmp_path / "t"))
    ids = {r.instruction: r.record_id for r in stored.collect()}
    assert set(ids.values()) == {str(k) for k in range(100)}
    assert {r.instruction: r.record_id for r in stored.repartition(3).collect()} == ids
    assert import_instructions(spark, lines.limit(0), str(tmp_path / "none")).count() == 0


def test_imported_rows_are_numbered_in_file_order(spark, tmp_path, conf):
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for name, n in (("b", 3), ("a", 4000), ("c", 0), ("d", 1200)):
        lines = [json.dumps({"instruction": f"{name}{k}"}) for k in range(n)]
        (folder / f"{name}.jsonl").write_text("".join(line + "\n" for line in lines))
    for name, n in (("a", 4000), ("b", 3), ("d", 1200)):
        want += [f"{name}{k}" for k in range(n)]
    # Splits far smaller than files, and read in whatever order.
    conf(spark__sql__files__maxPartitionBytes="7000", spark__sql__files__openCostInBytes="100")
    lines = tables.read_jsonl(spark, str(folder), INSTRUCTION)
    assert lines.rdd.getNumPartitions() > 10
    stored = import_instructions(spark, lines.select("instruction"), str(tmp_path / "t"))
    rows = sorted(stored.collect(), key=lambda r: r.seq)
    assert [r.seq for r in rows] == list(range(len(want))) and [r.instruction for r in rows] == want
    assert all(r.record_id == str(r.seq) for r in rows) and not tables.exists(spark, str(tmp_path / "t-order"))


def test_numbers_within_groups(spark, tmp_path):
    rows = [(g, k % 7, k) for g, n in (("a", 50), ("b", 1), ("c", 33)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, x int, y int").repartition(6)
    found = numbered(df, [F.col("x"), F.col("y")], str(tmp_path / "t"), within="g", parts=5).collect()
    for group in "abc":
        want = [r[1:] for r in sorted(r for r in rows if r[0] == group)]
        assert [(r.x, r.y) for r in sorted((r for r in found if r.g == group), key=lambda r: r.seq)] == want
        assert sorted(r.seq for r in found if r.g == group) == list(range(len(want)))


def test_running_sums(spark, tmp_path):
    rows = [(k, (k * 37) % 11) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, n long").repartition(7)
    found = {r.k: r.before for r in running_sum(df, [F.col("k")], "n", str(tmp_path / "t"), "before").collect()}
    assert found == {k: sum(n for j, n in rows if j < k) for k, _ in rows}


def test_no_task_numbers_all_rows(spark, tmp_path):
    df = spark.range(1000).repartition(4)
    for placed in (numbered(df, [F.col("id")], str(tmp_path / "a")), in_input_order(df, str(tmp_path / "b"))):
        assert "SinglePartition" not in plan_of(placed)


def test_a_log_is_read_by_position(spark, tmp_path):
    """The first row in the log wins, whatever its id and round."""
    rows = [{"record_id": "9", "instruction": "a", "round": 3, "refined_instruction": "first"}]
    rows += [{"record_id": str(k), "instruction": f"x{k}", "round": 0} for k in range(3000)]
    rows += [{"record_id": "1", "instruction": "a", "round": 0, "refined_instruction": "later"}]
    path = write(tmp_path / "cache.jsonl", *map(json.dumps, rows))
    asked = spark.createDataFrame([("q", "a")], "record_id string, instruction string")
    for positions, want in ((True, "first"), (False, "later")):
        log = tables.read_cache(spark, path, positions=positions)
        assert cache_lookup(asked, log).first().hit.refined_instruction == want


def test_a_broken_parquet_cache_is_empty(spark, tmp_path):
    path = tmp_path / "cache"
    cache = spark.createDataFrame([(str(k), f"text {k}") for k in range(2000)], "record_id string, instruction string")
    for name in CACHE.fieldNames()[2:]:
        cache = cache.withColumn(name, F.lit(None).cast(CACHE[name].dataType))
    cache.repartition(3).write.parquet(str(path))
    assert tables.read_cache(spark, str(path), "parquet").count() == 2000
    file = next(f for f in sorted(os.listdir(path)) if f.endswith(".parquet"))
    for keep in (0.9, 0.1):
        raw = (path / file).read_bytes()
        (path / file).write_bytes(raw[: int(len(raw) * keep)])
        (path / f".{file}.crc").unlink(missing_ok=True)
        empty = tables.read_cache(spark, str(path), "parquet")
        assert empty.schema == CACHE and empty.isEmpty()


def test_field_must_be_a_string(spark):
    lines = ['{"instruction":"a"}', '{"instruction":""}', '{"instruction":5}', '{"x":1}', "{bad"]
    lines += ['{"instruction":null}', '{"instruction":["a"]}', '{"instruction":{"a":"b"}}', "[1]"]
    lines += ['{"instruction":true}', '"text"']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = [r.instruction for r in text_field(df, "instruction").collect()]
    assert found == ["a", ""] + [None] * 9


def test_projection_and_empty_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, " ")], "id int, text string")
    rows = project_instruction(df, "id", "text")
    assert rows.columns == ["record_id", "instruction"] and rows.count() == 4
    assert [r.record_id for r in drop_empty(rows).collect()] == ["1", "4"]
    assert project_instruction(df, "id", "none").filter("instruction is null").count() == 4


def test_shared_dir_follows_the_session(spark, monkeypatch):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_DIR)
    assert new_workdir(spark, "a") != new_workdir(spark, "a")


class _Cluster:
    """A session that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "/shared/warehouse/" if key == WAREHOUSE_DIR else default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_without_a_shared_folder_the_warehouse_holds_it():
    assert shared_dir(_Cluster).startswith("/shared/warehouse/")


def test_folders_nobody_named_go_with_the_session(spark):
    path = new_workdir(spark, "a")
    assert tables.exists(spark, path) and path.startswith(shared_dir(spark))
    tables.drop_table(spark, path)
    assert not tables.exists(spark, path)
