import collections

import pytest
from conftest_llm import words
from pyspark.sql import functions as F

from prefspark.llm import mixing, sharding


def brute_targets(sizes):
    """Targets by resharing, as long as one is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_sources, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if weight[s] * level >= 2 * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_sources}
        for s in above:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_sources -= above
    return target


def test_targets_and_copies(spark, documents):
    rows = mixing.with_copies(documents).select("doc.*", "mix.*").collect()
    sizes = collections.Counter()
    for r in rows:
        assert r.size == len(words(r.text))
        sizes[r.source] += r.size
    want = brute_targets(sizes)
    taken = collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert int(r.target / r.source_size) <= r.copies <= 2
        taken[r.source] += r.size * r.copies
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 1000, None: 5}, {"a": 1}, {"a": 0, "b": 0}, {"ä": 7, "z": 7, "Z": 7, None: 7, "": 100},
    {f"s{k}": 10 ** (k % 5) for k in range(30)},
])
def test_targets_of_odd_sources(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_copies_follow_the_rate(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("source"))
    total = mixing.with_copies(docs).groupBy("doc.source").agg(F.sum("mix.copies").alias("n"), F.first("mix.target").alias("t")).collect()
    assert all(abs(r.n - r.t) < 0.03 * r.t for r in total)


def test_mix_edge_cases(spark, edge_docs, no_docs):
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    plan = mixing.with_copies(edge_docs).select("doc.doc_id", "mix.copies").collect()
    assert mixed.count() == sum(r.copies for r in plan)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(edge_docs).collect()))
    assert mixing.mix(no_docs).collect() == []


def brute_shards(rows, limit):
    """Splits a bucket of (place, bytes) on one more bit until it fits: place -> (bits, bytes)."""
    out = {}

    def split(bucket, depth):
        size = sum(b for _, b in bucket)
        if size <= limit or len({p for p, _ in bucket}) == 1:
            for p, _ in bucket:
                out[p] = (f"{p >> (60 - depth):0{depth}b}" if depth else "", size)
            return
        for bit in (0, 1):
            half = [x for x in bucket if x[0] >> (59 - depth) & 1 == bit]
            if half:
                split(half, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [1, 2_000, 30_000, 10**9])
def test_shards(spark, documents, limit):
    got = sharding.assign(documents, byte_limit=limit)
    places = {r.doc_id: r.place for r in documents.select("doc_id", sharding._place("doc_id", "text", 42).alias("place")).collect()}
    rows = got.collect()
    want = brute_shards([(places[r.doc_id], len(r.text.encode())) for r in rows], limit)
    assert {r.doc_id: (r.shard, r.shard_bytes) for r in rows} == {i: want[p] for i, p in places.items()}
    assert "Python" not in got._jdf.queryExecution().toString() and "Pandas" not in got._jdf.queryExecution().toString()


def test_repeated_rows_get_pages(spark):
    rows = [(1, "x" * 100)] * 50 + [(2, "y" * 100)] * 3 + [(3, "z" * 900)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), byte_limit=350).collect()
    assert len(got) == len(rows)
    shards = collections.defaultdict(int)
    for r in got:
        shards[r.shard] += r.bytes
    assert all(size <= 350 or size == 900 for size in shards.values())
    assert all(shards[r.shard] == r.shard_bytes for r in got)


def test_shard_edge_cases(spark, edge_docs, no_docs):
    got = sharding.assign(edge_docs, byte_limit=600)
    assert set(got.columns) == set(c for c in edge_docs.columns if c not in ("bytes", "shard")) | {"bytes", "shard", "shard_depth", "shard_bytes"}
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    assert all(r.bytes == len((r.text or "").encode()) for r in rows)
    assert sharding.assign(no_docs).collect() == []
