import random
import re
import tracemalloc

import numpy as np
from conftest_llm import words

from prefspark.llm import decontamination as d


def plain(text):
    return " ".join(w for w in (re.sub(r"[\W_]+", "", x) for x in words(text.lower())) if w)


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b):
            before, row[k + 1] = row[k + 1], before + 1 if x == y else max(row[k], row[k + 1])
    return row[-1]


def test_lcs():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 40))] for _ in range(2))
        assert d.lcs_length(a, b) == slow_lcs(a, b)


def test_passages_cover_each_word():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 15, 16, 17, 31, 32, 33, 47, 48, 100, 0, 5])
    tokens = rng.integers(0, 9, lengths.sum())
    weighted = rng.standard_normal((9, 4)).astype(np.float32)
    weighted[0] = 0
    sums, starts, ends, text = d.passage_sums(tokens, lengths, weighted)
    begins = np.cumsum(lengths) - lengths
    for total, low, high, t in zip(sums, starts, ends, text, strict=True):
        assert begins[t] <= low <= high <= begins[t] + lengths[t] and high - low < 3 * d.CELL
        assert np.allclose(total, weighted[tokens[low:high]].sum(axis=0), atol=1e-4)
    for t, n in enumerate(lengths):
        mine = [(a, b) for a, b, x in zip(starts, ends, text, strict=True) if x == t]
        assert mine[0][0] == begins[t] and mine[-1][1] == begins[t] + n


def test_documents_against_whole_text_search(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    want = {(i, r.item_id) for r in items.collect() for i, t in texts.items() if f" {plain(r.text)} " in f" {t} "}
    found = {(r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()}
    assert want <= found
    assert len(found - want) <= 0.1 * len(want)
    kept = {r.doc_id for r in d.decontaminate(docs, items).collect()}
    assert kept == set(texts) - {i for i, _ in found}


def test_paraphrases_and_answers(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(rng.randrange(20, 60)) for _ in range(60)]
    docs = []
    for k, item in enumerate(items):
        changed = [w if rng.random() > 0.15 else rng.choice(vocabulary) for w in item]
        dropped = [w for w in item if rng.random() > 0.1]
        other = list(item)
        rng.shuffle(other)
        for kind, inner in enumerate((item, changed, dropped, other, [])):
            docs.append((10 * k + kind, " ".join(w.upper() + "," for w in text(150) + inner + text(90))))
    # In a third item of four words are others and the answer is gone, or not.
    answer = [w if j % 3 or j >= len(items[0]) - 5 else f"new{j}" for j, w in enumerate(items[0])]
    no_answer = [w if j % 3 and j < len(items[0]) - 5 else f"new{j}" for j, w in enumerate(items[0])]
    docs += [(9001, " ".join(text(50) + answer + text(50))), (9002, " ".join(text(50) + no_answer + text(50)))]
    benchmark = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.item_id) for r in d.leaks(df, benchmark).collect()}
    assert {(10 * k + kind, k) for k in range(60) for kind in (0, 2)} <= found
    assert len({(10 * k + 1, k) for k in range(60)} & found) >= 54
    assert all(i == 9001 or i % 10 in (0, 1, 2) for i, _ in found if i != 9002)
    assert (9001, 0) in found and (9002, 0) not in found


def test_slices_give_the_same(spark, documents, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    pairs = lambda: {(r.doc_id, r.item_id) for r in d.leaks(documents, items).collect()}
    whole = pairs()
    monkeypatch.setattr(d, "SLICE_WORDS", 500)
    assert pairs() == whole


def test_edge_cases(spark, edge_docs, no_docs):
    rows = [(1, " ".join(f"copied{k}" for k in range(5, 45)), 1.0), (2, None, 1.0), (3, " !! ", 1.0), (None, " ".join(f"word{k} and more{k}" for k in range(600, 620)), 2.0)]
    items = spark.createDataFrame(rows, "item_id long, text string, doc_id double")
    found = {(r.doc_id, r.item_id) for r in d.leaks(edge_docs, items).collect()}
    assert found == {(5, 1), (6, 1), (None, 1), (7, None)}
    assert sorted(r.doc_id for r in d.decontaminate(edge_docs, items).collect()) == [1, 2, 3, 4, 8, 9, 10, 11, 11]
    assert d.leaks(no_docs, items).collect() == [] and d.leaks(edge_docs, items.limit(0)).collect() == []
    assert d.decontaminate(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_short_item_with_an_answer(spark):
    """A paraphrase of an item under ten words leaks if the given answer follows, and only then."""
    rng = random.Random(6)
    filler = lambda n: " ".join(f"f{rng.getrandbits(30)}" for _ in range(n))
    changed = "which river runs oddly beyond old vienna today"
    docs = [(1, f"{filler(40)} {changed} danube {filler(40)}"), (2, f"{filler(40)} {changed} rhine {filler(40)}")]
    docs += [(k, filler(80)) for k in range(3, 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "which river flows through the old vienna today", "Danube")], "item_id long, text string, answer string")
    assert [r.doc_id for r in d.leaks(df, items, answer_col="answer").collect()] == [1]
    (item,) = d.Items([(1, "one two three four five", "six")]).words
    assert d.Items([(1, "one two three four five", "six")]).leak(0, [1, 2, 3, 9, 9, 6], 0, 6) and len(item) == 5
    assert d.Items([(1, "one two three four five", None)]).leak(0, [1, 2, 3, 9, 9, 6], 0, 6) is None


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    item, clean = text(40), text(100)
    df = spark.createDataFrame([(1, f"{text(50)} {item} {text(50)}"), (1, clean), (2, clean)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.text) for r in d.decontaminate(df, items).collect()) == [(1, clean), (2, clean)]


def planted(documents, items, seed=5):
    """Documents with an item in each, copied or changed: words replaced (15 to 44 percent) or left out."""
    rng = random.Random(seed)
    vocabulary = sorted({w for text in documents.values() for w in text.split()})
    rows = []
    for k, (doc_id, text) in enumerate(sorted(documents.items())):
        inner = list(items[k % len(items)][1].split())
        kind = k % 4
        if kind == 1:
            share = rng.uniform(0.15, 0.44)
            inner = [w if rng.random() > share else rng.choice(vocabulary) for w in inner]
        elif kind == 2:
            inner = [w for w in inner if rng.random() > 0.2]
        elif kind == 3:
            inner = [w for w in inner if rng.random() > 0.1 for w in ([w, rng.choice(vocabulary)] if rng.random() < 0.1 else [w])]
        words = text.split()
        at = rng.randrange(len(words) + 1)
        rows.append((doc_id, " ".join(words[:at] + inner + words[at:])))
    return rows


def every_leak(rows, items):
    """The pairs whose words and answers agree, by comparing every item with every place of every text."""
    known = d.Items([(i, text, None) for i, text in items])
    found = set()
    for doc_id, text in rows:
        words = [known.vocabulary.get(w, 0) for w in d.plain_words(text)]
        found |= {(doc_id, known.ids[k]) for k in range(len(known.ids)) if known.leak(k, words, 0, len(words))}
    return found


def test_recall_against_a_search_of_every_place(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()]
    rows = planted(texts, items)
    want = every_leak(rows, items)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 150 and found <= want | found
    recall = len(want & found) / len(want)
    print(f"recall {recall:.4f} of {len(want)}")
    assert recall >= 0.98
    # Every link that was found is one of the plain search, but for places that it starts from.
    assert len(found - want) <= 0.02 * len(want)


def test_passages_that_are_left_out_are_no_candidates():
    """The bounds leave out no passage that reaches the part along any vector."""
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(f"w{j}" for j in rng.integers(0, 400, 40)), None) for k in range(50)]
    items = d.Items(rows)
    size = len(items.vocabulary) + 1
    idf = np.concatenate(([0.0], rng.uniform(0.1, 5, size - 1))).astype(np.float32)
    index = d.Index(items, (rng.standard_normal((size, 30)) * idf[:, None]).astype(np.float32), idf)
    lengths = rng.integers(0, 300, 60)
    tokens = rng.integers(0, size, lengths.sum()).astype(np.int32)
    sums, starts, _, text = d.passage_sums(tokens, lengths, index.basis)
    part = float(np.quantile((sums @ index.vectors.T / index.whole).max(axis=1), 0.7))
    want = set()
    for row, start, t in zip(sums, starts, text):
        for q in np.flatnonzero(row @ index.vectors.T >= part * index.whole):
            want.add((int(t), int(start), int(index.owner[q])))
    found = {c[:3] for c in index.candidates(tokens, lengths, -2.0, part)}
    kept = len(d.passage_sums(tokens, lengths, index.basis, index.bounds, part)[0])
    assert want and found == want and kept < len(sums)


def test_texts_are_read_once_for_all_slices(spark, documents, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    calls, encoded = [], d.encoded
    monkeypatch.setattr(d, "encoded", lambda *args: calls.append(1) or encoded(*args))
    monkeypatch.setattr(d, "SLICE_WORDS", 400)
    monkeypatch.setattr(d, "SLICES", 3)
    assert d.leaks(documents, items).count() > 0 and len(calls) == 1


def test_one_text_that_is_an_item(spark):
    """Words that are in all cells still weigh enough to be found."""
    text = " ".join(f"w{k}" for k in range(25))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert d.leaks(docs, spark.createDataFrame([(7, text)], "item_id long, text string")).first()[:3] == (1, 7, 1.0)


def test_basis_is_found_in_tasks(spark):
    """The singular vectors are those of the whole matrix, and the driver holds no copies of
    the product's matrices."""
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 3000, 40)), None) for k in range(100)]
    items = d.Items(rows)
    idf = np.append(0, rng.uniform(1, 5, len(items.vocabulary))).astype(np.float32)
    places = d.item_passages(items.lengths)
    whole = np.stack([np.bincount(items.tokens[low:high], minlength=len(idf)) * idf for _, low, high in places]).astype(float)
    whole /= np.linalg.norm(whole, axis=1)[:, None]
    tracemalloc.start()
    basis = d.latent_basis(spark, items, idf)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    _, strengths, vectors = np.linalg.svd(whole, full_matrices=False)
    rank = basis.shape[1]
    assert (strengths[:rank] ** 2).sum() >= d.ENERGY * (strengths**2).sum()
    found = basis[1:] / idf[1:, None]
    assert np.allclose(found @ found.T, vectors[:rank, 1:].T @ vectors[:rank, 1:], atol=1e-3)
    assert most < 2 * len(idf) * (len(places) + 16) * 8
