import hashlib

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from prefspark.operators.sampling import sample_fraction, sample_size, shuffled


def numbered(spark, n, partitions=3):
    return spark.range(n).select(
        F.col("id").cast("string").alias("record_id"), (F.col("id") * 2).alias("x")
    ).repartition(partitions)


def in_hash_order(n, seed=42):
    return sorted(
        (str(i) for i in range(n)), key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i)
    )


def ids(df):
    return {r.record_id for r in df.collect()}


@pytest.mark.parametrize(
    "n, fraction, size",
    [(100, 0.5, 50), (100, 0.29, 28), (0, 0.5, 0), (7, 0.0, 0), (7, 1.0, 7), (1, 0.5, 0), (3, 0.34, 1)],
)
def test_fraction_is_exact(spark, n, fraction, size):
    assert ids(sample_fraction(numbered(spark, n), fraction)) == set(in_hash_order(n)[:size])


@pytest.mark.parametrize("size", [0, 1, 50, 99, 100])
def test_size_is_exact(spark, size):
    assert ids(sample_size(numbered(spark, 100), size)) == set(in_hash_order(100)[:size])


@pytest.mark.parametrize("digits", [1, 2, 5, 32])
def test_any_number_of_passes_gives_the_same(spark, digits):
    sample = sample_size(numbered(spark, 300), 77, digits=digits)
    assert ids(sample) == set(in_hash_order(300)[:77])


def test_repeated_and_missing_ids(spark):
    order = in_hash_order(4)
    rows = [(i,) for i in order] + [(order[1],)] * 2
    df = spark.createDataFrame(rows, "record_id string")
    assert sample_size(df, 1).collect() == [(order[0],)]
    for size in (2, 3, 4, 5):
        want = sorted(([order[0]] + [order[1]] * 3 + order[2:])[:size])
        assert sorted(r.record_id for r in sample_size(df, size).collect()) == want
    assert sample_fraction(df, 5 / 6).count() == 5
    nulls = spark.createDataFrame([(None,), (None,)], "record_id string")
    assert [sample_size(nulls, k).count() for k in range(3)] == [0, 1, 2]
    assert sample_fraction(nulls, 0.5).count() == 1


def content(row):
    sized = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    return hashlib.md5("".join(sized).encode()).hexdigest()


def mixed_rows(n=600):
    """A third without an id, a third with a few, and equal rows among both."""
    rows = []
    for k in range(n):
        record_id = None if k % 3 == 0 else str(k % 5) if k % 3 == 1 else str(k)
        rows.append((record_id, "same" if k % 2 else f"text {k % 100}", k % 4))
    return rows


@pytest.mark.parametrize("size", [0, 1, 60, 130, 200, 201, 333, 500, 599, 600])
def test_ties_go_by_content_and_equal_rows_by_number(spark, size):
    rows = mixed_rows()
    key = lambda r: (hashlib.md5(f"42:{r[0] or ''}".encode()).hexdigest(), content(r))
    want = sorted(sorted(rows, key=key)[:size], key=str)
    for partitions in (1, 9):
        df = spark.createDataFrame(rows, "record_id string, text string, x int").repartition(partitions, "x", "text")
        assert sorted((tuple(r) for r in sample_size(df, size, digits=1).collect()), key=str) == want


def test_equal_rows_are_dealt_from_many_files(spark):
    df = spark.range(1000, numPartitions=8).select(F.lit(None).cast("string").alias("record_id"), F.lit(1).alias("x"))
    sample = sample_fraction(df, 0.33)
    assert sample.count() == 330 and sample.columns == ["record_id", "x"]
    assert "Exchange" not in plan_of(sample)


def test_shuffled_rows_have_places_in_sample_order(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "record_id string, text string, x int").repartition(5)
    placed = shuffled(df)
    assert placed.columns == ["record_id", "text", "x", "place"] and "SinglePartition" not in plan_of(placed)
    found = sorted((tuple(r) for r in placed.collect()), key=lambda r: r[3])
    assert [r[3] for r in found] == list(range(len(rows)))
    key = lambda r: (hashlib.md5(f"42:{r[0] or ''}".encode()).hexdigest(), content(r))
    assert [r[:3] for r in found] == sorted(rows, key=key)
    head = sorted((r[:3] for r in found[:77]), key=str)
    assert sorted((tuple(r) for r in sample_size(df, 77).collect()), key=str) == head


def test_partitioning_does_not_matter_and_the_seed_does(spark):
    samples = [ids(sample_fraction(numbered(spark, 500, p), 0.3)) for p in (1, 2, 7)]
    assert samples[0] == samples[1] == samples[2]
    other = ids(sample_fraction(numbered(spark, 500), 0.3, seed=7))
    assert other == set(in_hash_order(500, 7)[:150]) and other != samples[0]


def test_impossible_sizes(spark):
    for fraction in (-0.1, 1.1):
        with pytest.raises(ValueError):
            sample_fraction(numbered(spark, 5), fraction)
    with pytest.raises(ValueError, match="fewer"):
        sample_size(numbered(spark, 5), 6)
    with pytest.raises(ValueError, match="fewer"):
        sample_size(numbered(spark, 0), 1)
    with pytest.raises(ValueError):
        sample_size(numbered(spark, 5), -1)
    assert sample_size(numbered(spark, 0), 0).isEmpty()


def test_the_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    numbered(spark, 50).write.parquet(path)
    plan = plan_of(sample_fraction(spark.read.parquet(path), 0.5))
    assert "Exchange" not in plan and "Window" not in plan
