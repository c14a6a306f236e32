"""Near-duplicates against all pairs of sets of shingles, on both sides of the threshold."""

import itertools
import random

import numpy as np
import pytest
from conftest_llm import LOWER, words

import corpus_pipeline
from prefspark.llm import jaccard, simhash


def brute_sets(texts, shingle=5):
    sets = {}
    for i, text in texts.items():
        w = words((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    return sets


def brute_kept(texts, similarity=0.8):
    """Ids that are the smallest of their component; two empty sets are equal."""
    sets = brute_sets(texts)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small < similarity * large - 1e-6:
            continue
        common = len(sets[a] & sets[b])
        if sets[a] == sets[b] or common / (len(sets[a]) + len(sets[b]) - common) >= similarity:
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    return sorted(i for i in sets if root(i) == i)


def changed(rng, text, edits):
    """The words with a run of new ones at each of some places far from each other."""
    out = list(text)
    for k in rng.sample(range(0, len(out) - 5, 5), edits):
        out[k] = f"new{rng.getrandbits(40)}"
    return out


@pytest.fixture(scope="module")
def pairs():
    """Texts of 300 words and copies of them, from hardly to much changed, and short and long ones."""
    rng = random.Random(8)
    texts = []
    for n in (40, 300, 300, 300, 300, 1200):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        texts.append(base)
        texts += [changed(rng, base, edits) for edits in range(1, n // 40 + 4)]
    texts += [["common", "licence", "line", "of", "many", "texts"] + [f"u{rng.getrandbits(40)}" for _ in range(30)] for _ in range(40)]
    return {k: " ".join(t) for k, t in enumerate(texts)}


def kept(spark, texts, **options):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    return sorted(r.doc_id for r in simhash.near_dedup(df, shingle=5, max_bits=7, **options).collect())


def test_pairs_on_both_sides(spark, pairs):
    sets = brute_sets(pairs)
    near = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(pairs, 2)]
    assert sum(0.8 <= s < 0.9 for s in near) > 10 and sum(0.6 < s < 0.8 for s in near) > 10
    assert kept(spark, pairs) == brute_kept(pairs)


def test_stage(spark, texts):
    want = brute_kept(texts)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()) == want


def test_crowd_of_near_copies(spark, monkeypatch):
    """Copies of one text at 0.6 to 0.9 of each other, in buckets that are dealt to several tasks."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    texts = {k: " ".join(changed(rng, base, rng.randrange(1, 6))) for k in range(120)}
    want = brute_kept(texts)
    assert 1 < len(want) < 100
    found = simhash.jaccard.linked_components
    monkeypatch.setattr(simhash.jaccard, "linked_components", lambda *a: found(*a, crowd=20))
    assert kept(spark, texts) == want


def test_exactly_at_the_threshold():
    whole = np.arange(5, dtype=np.uint64)
    assert jaccard.similarity_of(whole, whole[:4]) >= 0.8
    assert jaccard.similarity_of(whole, whole[:3]) < 0.8


def test_one_id_with_two_texts(spark):
    """Texts that share an id but nothing else are not copies of each other."""
    rows = [(1, "a first text of some seven words"), (1, "and quite another with no word alike"), (1, "a first text of some seven words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.text for r in simhash.near_dedup(df).collect()) == sorted({t for _, t in rows})


def test_near_fingerprints_below_the_threshold_stay(spark):
    """Texts within 7 bits of an earlier one and under 0.75 of its shingles are no copies of it."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(300)]
    print_of = simhash.fingerprint(" ".join(base), 5)
    texts = {0: " ".join(base)}
    for k in range(1, 3000):
        text = " ".join(changed(rng, base, 11))
        sets = brute_sets({0: texts[0], k: text})
        near = len(sets[0] & sets[k]) / len(sets[0] | sets[k])
        if near < 0.75 and (print_of ^ simhash.fingerprint(text, 5)).bit_count() <= 7:
            texts[k] = text
    assert len(texts) > 3
    assert kept(spark, texts) == brute_kept(texts) == sorted(texts)
