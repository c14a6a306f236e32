import itertools
import math
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SF_DIR, words
from pyspark.sql import functions as F

from prefspark.llm import quality, rules
from prefspark.llm.common import fold
from prefspark.llm.queries import op4_quality_rules


def brute_measures(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def check(df, source):
    texts = Counter((r.doc_id, r.text) for r in source.collect())
    rows = df.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == texts
    for r in rows:
        want = brute_measures(r.text)
        assert {name: r[name] for name in rules.MEASURES} == want
        assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert r.kept == (r.rejected_by is None) and not (r.kept and r.base_failed)


def test_measures(spark, documents):
    check(rules.cascade(documents, measures=True), documents)


def test_rules_edge_cases(spark, edge_docs, no_docs):
    check(rules.cascade(edge_docs, measures=True), edge_docs.select("doc_id", "text"))
    assert rules.cascade(no_docs, measures=True).collect() == []
    assert "SCORE" in rules.cascade(edge_docs).columns


def brute_kept(text):
    """The verdict of all rules, from the plain measures."""
    m = brute_measures(text)
    text = text or ""
    lines = sum(1 for line in text.split("\n") if words(line))
    shouted = sum(1 for w in text.split() if len(w) > 1 and w.isupper())
    n = m["n_words"]
    bad = [
        n < 50, 100 * m["n_repeat_words"] > 50 * n, 10 * m["n_symbols"] > n, 10 * shouted > 3 * n, 10 * m["n_dup_lines"] > 3 * lines,
        not 2 * n <= m["word_chars"] <= 20 * n,
    ]
    return not any(bad)


def test_verdicts_are_those_of_all_rules(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for df in (docs, edge_docs.select("doc_id", "text")):
        for r in rules.cascade(df, measures=True).collect():
            assert r.kept == brute_kept(r.text)
    kept = [sorted(r.doc_id for r in rules.cascade(docs, order=order).where("kept").collect()) for order in (rules.RULES, rules.RULES[::-1])]
    assert kept[0] == kept[1]


def test_registered_query(spark, texts):
    rows = op4_quality_rules(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = brute_measures(texts[r.doc_id])
        assert {name: r[name] for name in rules.MEASURES} == want and r.kept == brute_kept(texts[r.doc_id])


def slow(n):
    return sum(range(n))


def test_order_follows_rejections_left_and_cost_beyond_what_is_made(spark, documents, monkeypatch):
    monkeypatch.setitem(rules.MAKERS, "dear", lambda t: slow(30_000))
    long = lambda t: len(t.text) > 1000
    cheap, dear = rules.Rule("cheap", long), rules.Rule("dear", lambda t: t.dear > 0 and long(t))
    shares = rules.Rule("shares", lambda t: t.dear > 0 and len(t.text) < 100)
    never = rules.Rule("never", lambda t: False)
    given = (never, dear, shares, cheap)
    # Makers travel by reference here, as the workers of this session import the module anew.
    sample = rules.Sample(
        {"dear": 1e-3, "cheap": 1e-6, "shares": 1e-6, "never": 1e-6}, {"dear": frozenset(["dear"]), "shares": frozenset(["dear"])},
        {0b1010: 60, 0b0100: 10, 0: 30},
    )
    # What `cheap` rejects leaves nothing for `dear`; `shares` pays for the measure.
    order = [r.name for r in rules.ordered(given, sample)]
    assert order[0] == "cheap" and order.index("shares") < order.index("dear")
    best = rules.ordered(given, sample)
    assert sample.work(best, given) == pytest.approx(min(sample.work(o, given) for o in itertools.permutations(given)))
    assert sample.work(best, given) < 0.5 * sample.work(given, given)
    # Measures that are made anyway cost nothing.
    assert rules.ordered(given, sample, ["dear"])[0].name in ("cheap", "dear")


def test_sampling(spark, documents):
    sample = rules.sampled(documents, sample_rows=100)
    assert 20 < sample.seen <= 200 and set(sample.reads["repetitive"]) == {"n_words", "words", "n_repeat_words"}
    assert sample.reads["shouting"] >= {"n_shouted"} and all(t >= 0 for t in sample.seconds.values())
    whole = rules.sampled(documents)
    texts = [r.text for r in documents.collect()]
    assert whole.seen == len(texts) and whole.patterns.get(0, 0) == sum(map(brute_kept, texts))
    best = rules.ordered(rules.RULES, whole)
    assert whole.work(best, rules.RULES) <= whole.work(rules.RULES[::-1], rules.RULES)
    named = rules.cascade(documents, order=best).select("doc_id", "rejected_by").collect()
    assert sorted(named, key=str) == sorted(rules.cascade(documents, order=best).select("doc_id", "rejected_by").collect(), key=str)


def test_own_rules(spark, documents):
    mine = (rules.Rule("long", lambda t: len(t.text) > 1000), rules.Rule("few", lambda t: t.n_words < 10, base=True))
    for r in rules.cascade(documents, mine, measures=True).collect():
        assert r.base_failed == (r.n_words < 10) and r.kept == (len(r.text or "") <= 1000 and r.n_words >= 10)


def test_good_documents_stay_and_junk_goes(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = rules.cascade(docs, measures=True).join(labels, "doc_id").where("n_words >= 50").collect()
    good, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held_out = fold(F.col("doc_id"), 3) == 1
    rows = quality.classify(docs, labels, held_out=held_out).where(held_out).join(labels, "doc_id").collect()
    good, junk = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum(g > j for g in good for j in junk) / (len(good) * len(junk)) > 0.98
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def risk(x, good, prior, weights, l2=quality.L2):
    """The non-negative risk, written out."""
    loss = lambda z: np.logaddexp(0, -z)
    g = x @ weights
    rest = loss(-g).mean() - prior * loss(-g[good]).mean()
    return prior * loss(g[good]).mean() + max(0.0, rest) + l2 / 2 * weights @ weights


def test_the_fit_is_the_least_risk(spark):
    """Against plain descent on the whole risk, from several places."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    marks = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    x = np.array([quality.features(t) for _, t in rows], dtype=float)
    good = np.array([i in marks for i, _ in rows])
    for prior in (0.3, 0.8):
        model = quality.fit(docs, labels, prior=prior)
        found = risk(x, good, prior, np.array(model.weights))
        rng, least = np.random.default_rng(1), np.inf
        for start in (np.zeros(quality.WIDTH), rng.standard_normal(quality.WIDTH)):
            w, rate = start.copy(), 0.5
            for _ in range(4000):
                g = x @ w
                p = 1 / (1 + np.exp(-g))
                rest = np.logaddexp(0, g).mean() - prior * np.logaddexp(0, g[good]).mean()
                part = x.T @ p / len(x) - prior * (x[good].T @ p[good]) / good.sum()
                step = (prior * (x[good].T @ (p[good] - 1)) / good.sum() + part if rest >= 0 else -part) + quality.L2 * w
                w -= rate * step
                least = min(least, risk(x, good, prior, w))
        assert found <= least + 2e-3, prior


def test_the_prior_is_that_of_the_unlabelled_texts(spark):
    """Without reading a label of zero; against the share of good ones among the labelled."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    known = [r.quality for r in labels.where("quality is not null").collect()]
    assert abs(model.prior - sum(known) / len(known)) < 0.1
    assert quality.fit(docs, labels.where("quality = 1")).prior == model.prior


@pytest.mark.parametrize("share", [0.1, 0.4, 0.8])
def test_the_bound_of_the_prior(share):
    rng = np.random.default_rng(3)
    n, n_good, bins = 40_000, 5_000, 200
    of_good = lambda k: rng.beta(8, 2, k)
    is_good = rng.random(n) < share
    scores = np.where(is_good, of_good(n), rng.beta(2, 8, n))
    count = lambda s: np.cumsum(np.bincount((s * bins).astype(int), minlength=bins)[::-1])
    assert quality.prior_bound(count(scores), count(of_good(n_good))) == pytest.approx(share, abs=0.03)
    assert quality.prior_bound(np.zeros(5), np.zeros(5)) == quality.PRIOR


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held_out = fold(F.col("doc_id"), 3) == 1
    turned = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(documents, table, train=~held_out) for table in (labels, turned))
    assert a.weights == pytest.approx(b.weights, rel=1e-6, abs=1e-9) and a.prior == b.prior


def test_classifier_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 1), (5, None), (6, 0), (8, 0), (8, 1), (None, 1), (99, 1)], "doc_id long, quality int")
    rows = quality.classify(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert all(math.isfinite(r.score) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if not words(r.text)}) == 1
    assert quality.classify(no_docs, labels).collect() == []
    assert {r.score for r in quality.classify(edge_docs, labels.limit(0)).collect()} == {0.5}
