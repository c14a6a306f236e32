"""The registered queries against their SQL, and the pipeline against its stages by brute force."""

import collections

import pytest
from check_queries import connect, difference
from conftest_llm import SF_DIR, words

import corpus_pipeline
from prefspark.llm import decontamination, quality
from prefspark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_each_operator_has_one_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, len(QUERIES) + 1)]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], FOLDER).cache())
        if name != "sharding":
            assert seen[-1].columns == docs.columns, name
    original = {r.doc_id: r for r in docs.collect()}
    ids = [[r.doc_id for r in df.collect()] for df in seen]
    model = quality.fit(docs, labels)
    assert sorted(ids[1]) == sorted(r.doc_id for r in model.score(docs).where("score >= 0.5").collect())
    assert len(ids[2]) == len(set(ids[2])) and set(ids[2]) <= set(ids[1])
    texts = collections.Counter(original[i].text for i in ids[2])
    assert max(texts.values()) == 1 and {original[i].text for i in ids[1]} == set(texts) | {original[i].text for i in set(ids[1]) - set(ids[2])}
    leaking = {r.doc_id for r in decontamination.leaks(seen[2], spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert sorted(ids[3]) == sorted(set(ids[2]) - leaking)
    assert set(ids[4]) <= set(ids[3]) and max(collections.Counter(ids[4]).values()) <= 2
    assert sum(len(words(original[i].text)) for i in ids[4]) == pytest.approx(1.5 * sum(len(words(original[i].text)) for i in ids[3]), rel=0.15)
    assert sorted(ids[5]) == sorted(ids[4])
    assert all(r.text == original[r.doc_id].text for r in seen[5].collect())
    assert corpus_pipeline.run(spark, FOLDER).count() == len(ids[5])
