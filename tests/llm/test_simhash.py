import itertools
import random

import numpy as np
import pytest
import xxhash
from conftest_llm import LOWER, words

from prefspark.llm import simhash
from prefspark.llm.components import components


def brute_print(text, shingle=4):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits):
    """id -> smallest id that links lead to."""
    label = {i: i for i in prints}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= max_bits]
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


def test_documents(spark, documents, texts):
    got = {r.doc_id: (r.simhash % 2**64, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    label = brute_components(prints, 4)
    assert got == {i: (prints[i], label[i]) for i in texts}


@pytest.mark.parametrize("max_bits", [0, 2, 4, 5, 7])
def test_links_near_and_far(spark, max_bits):
    """Fingerprints at all distances around the threshold, in chains and in a crowd."""
    rng = random.Random(max_bits)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in list(prints):
        near = p
        for b in rng.sample(range(64), rng.randrange(1, max_bits + 3)):
            near ^= 1 << b
        prints.append(near)
    prints += [prints[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20) if a != b]
    signed = sorted({int(np.uint64(p).astype(np.int64)) for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "simhash long").repartition(4)
    found = simhash.links(df, max_bits, hot_anchor=50)
    got = {r.node: r.label for r in components(found).collect()}
    want = brute_components({p: p % 2**64 for p in signed}, max_bits)
    assert {p: got.get(p, p) for p in signed} == want


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(2000 + k, 2000 + (k + 1) % 50) for k in range(50)]
    edges += [(5000, 5000), (7, 6), (6, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(300)} | {2000 + k: 2000 for k in range(50)}


def test_every_code_word_covers():
    for code in simhash.coverings(4) + simhash.coverings(7):
        prints = np.random.default_rng(code.width).integers(0, 2**64, 500, dtype=np.uint64)
        where, anchors, home = code.anchors(prints)
        assert np.bincount(where[home], minlength=500).tolist() == [1] * 500
        pieces = code.piece(prints)
        assert np.bitwise_count(pieces[where[home]] ^ anchors[home].astype(np.uint64)).max() <= 1


def test_edge_cases(spark, edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {(r.doc_id, r.component_id) for r in rows if r.simhash == 0} == {(1, 1), (2, 1), (3, 1)}
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (5, 6)} == {(5, 5), (6, 5)}
    kept = simhash.near_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 4, 5, 7, 8, 9, 10, 11]


def test_empty(spark, no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.near_dedup(no_docs).collect() == []
