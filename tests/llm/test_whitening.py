import math
import random

import numpy as np
import pytest
from conftest_llm import SF_DIR
from pyspark.sql import functions as F

from prefspark.llm import whitening
from prefspark.llm.queries import op12_embedding_whitening

SCHEMA = "vec_id long, embedding array<double>, row string, result int, x string, digest string, rows int"
FILL = ("r", 1, "x", "d", 2)


def brute(vectors, multiplicity=True, components=8):
    """For vectors (lists, all of them taken): the fit, and per vector its deviation and coordinates."""
    x = [[math.floor(c * 1024) + 100_000 for c in v] for v in vectors]
    fitted = x if multiplicity else [list(v) for v in sorted(set(map(tuple, x)))]
    n, sums = len(fitted), [sum(column) for column in zip(*fitted)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fitted) - mean
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return n, deviations, (np.array(x) - mean) @ axes / np.sqrt(values), values / np.trace(covariance)


def agree(rows, vectors, **options):
    """Rows (vec_id, result) against brute force over {vec_id: vector}."""
    ids = list(vectors)
    n, deviations, coordinates, explained = brute([vectors[i] for i in ids], **options)
    assert sorted(r.row.vec_id for r in rows) == sorted(ids)
    got = {r.row.vec_id: r.result for r in rows}
    mine = np.array([got[i].whitened for i in ids])
    signs = np.sign((mine * coordinates).sum(axis=0))
    assert np.allclose(mine * signs, coordinates, rtol=1e-7, atol=1e-7)
    assert [got[i].deviation for i in ids] == deviations
    for r in got.values():
        assert r.n == n and np.allclose(r.explained, explained, rtol=1e-9) and 0 <= r.identity_error < 1e-9


def random_vectors(n, dim, seed=1):
    rng = random.Random(seed)
    return [[rng.gauss(0, 1 + k) for k in range(dim)] for _ in range(n)]


def test_query(spark):
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    n, deviations, coordinates, explained = brute(list(given.values()))
    rows = op12_embedding_whitening(spark, SF_DIR)
    assert dict(rows.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
        "identity_error": "double",
    }
    rows = rows.collect()
    assert len(rows) == 8 * len(given) and len({(r.vec_id, r.component) for r in rows}) == len(rows)
    by_id = dict(zip(given, deviations))
    got = np.zeros((len(given), 8))
    place = {i: k for k, i in enumerate(given)}
    for r in rows:
        assert (r.n, r.deviation) == (n, by_id[r.vec_id]) and r.identity_error < 1e-4
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        got[place[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((got * coordinates).sum(axis=0))
    assert np.allclose(got * signs, coordinates, rtol=1e-7, atol=1e-7)


@pytest.mark.parametrize("multiplicity", [True, False])
def test_copies_weigh_as_asked_and_meet_their_result(spark, multiplicity):
    vectors = dict(enumerate(random_vectors(60, 5)))
    hot = vectors[0]
    for i in range(100, 400):  # one vector holds most rows
        vectors[i] = hot
    for i in range(500, 520):
        vectors[i] = vectors[i - 499]
    rows = [(i, v, *FILL) for i, v in vectors.items()]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA), multiplicity=multiplicity)
    assert found.select("row.*").columns == [c.split()[0] for c in SCHEMA.split(", ")]
    agree(found.collect(), vectors, multiplicity=multiplicity)


def test_both_joins_give_the_same(spark, monkeypatch):
    vectors = dict(enumerate(random_vectors(50, 4) * 3))
    df = spark.createDataFrame([(i, v, *FILL) for i, v in vectors.items()], SCHEMA)
    for share in (1e-9, 2.0):  # all vectors are hot, or none
        monkeypatch.setattr(whitening, "HOT", share)
        agree(whitening.whiten(df).collect(), vectors)


def test_rows_left_out(spark):
    vectors = dict(enumerate(random_vectors(30, 3)))
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, *FILL) for i, v in vectors.items()] + [(1000 + k, v, *FILL) for k, v in enumerate(bad)]
    agree(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), vectors)


def test_rows_without_an_id_and_repeated_rows(spark):
    vectors = random_vectors(20, 3)
    rows = [(None, v, *FILL) for v in vectors] + [(7, vectors[0], *FILL)] * 4
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 24 and sum(r.row.vec_id == 7 for r in found) == 4 and {r.result.n for r in found} == {24}
    assert len({tuple(r.result.whitened) for r in found}) == 20


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0], *FILL)], [(i, [0.5, 1.0], *FILL) for i in range(9)], [(1, None, *FILL)]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.count() == 0 and found.columns == ["row", "result"]


def test_components_without_variance_are_left_out(spark):
    vectors = {i: [a, 2 * a, b] for i, (a, b) in enumerate((float(k), float(k * k % 7)) for k in range(20))}
    found = whitening.whiten(spark.createDataFrame([(i, v, *FILL) for i, v in vectors.items()], SCHEMA)).collect()
    assert {len(r.result.whitened) for r in found} == {2}
    y = np.array([r.result.whitened for r in found])
    assert np.allclose(np.cov(y.T, bias=True), np.eye(2), atol=1e-9)


def test_deviations_beyond_a_long(spark):
    vectors = {0: [1e9, 0.0], 1: [-1e9, 1.0], 2: [0.5, 2.0]}
    found = {r.row.vec_id: r.result for r in whitening.whiten(spark.createDataFrame([(i, v, *FILL) for i, v in vectors.items()], SCHEMA)).collect()}
    x = {i: [math.floor(c * 1024) + 100_000 for c in v] for i, v in vectors.items()}
    sums = [sum(c) for c in zip(*x.values())]
    for i, v in x.items():
        want = sum((3 * c - s) ** 2 for c, s in zip(v, sums))
        assert found[i].deviation == (want if want < 2**63 else None)
    assert found[0].deviation is None


def test_partitions_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(whitening, "COMBINED", 2)
    vectors = dict(enumerate(random_vectors(200, 6)))
    df = spark.createDataFrame([(i, v, *FILL) for i, v in vectors.items()], SCHEMA)
    for n in (1, 23):
        agree(whitening.whiten(df.repartition(n, F.col("vec_id"))).collect(), vectors)
