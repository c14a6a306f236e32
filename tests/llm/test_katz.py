import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_llm import LOWER, words
from pyspark.sql import functions as F

from prefspark.llm import blocks, katz
from prefspark.llm.common import fold


class Brute:
    """The model, n-gram by n-gram, in plain Python."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for tokens in texts:
            line = ["<s>", *tokens]
            for k, token in enumerate(tokens):
                self.counts[1][(token,)] += 1
                for n in range(2, order + 1):
                    if k + 2 >= n:
                        self.counts[n][tuple(line[k + 2 - n : k + 2])] += 1
        self.d = [None] + [self.discounts(c) for c in self.counts[1:]]
        self.total = sum(self.counts[1].values())
        freed = sum((1 - self.d[1](c)) * c for c in self.counts[1].values())
        self.norm = self.total + (freed == 0)
        self.unknown = freed / self.norm if freed else 1 / self.norm
        self.after = defaultdict(list)
        for n in range(2, order + 1):
            for gram in self.counts[n]:
                self.after[gram[:-1]].append(gram[-1])
        self.weights = {}

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        rest, d = (6 * n[6] / n[1] if n[1] else 1.0), {}
        for c in range(1, 6):
            good = ((c + 1) * n[c + 1] / (c * n[c]) - rest) / (1 - rest) if n[c] and rest != 1 else 0
            d[c] = good if 0 < good < 1 else (c - 0.5) / c
        return lambda c: d.get(c, 1.0)

    def weight(self, history):
        if history not in self.weights:
            n = len(history) + 1
            counts = [self.counts[n][(*history, w)] for w in self.after[history]]
            if not counts:
                self.weights[history] = 1.0, 0.0
            else:
                freed = sum((1 - self.d[n](c)) * c for c in counts)
                norm = sum(counts) + (freed == 0)
                lower = sum(self.p(history[1:], w) for w in self.after[history])
                self.weights[history] = (freed or 1.0) / norm / (1 - lower), norm
        return self.weights[history]

    def p(self, history, word):
        c = self.counts[len(history) + 1][(*history, word)]
        d = self.d[len(history) + 1](c)
        if not history:
            return d * c / self.norm if c else self.unknown
        alpha, norm = self.weight(history)
        return d * c / norm if c else alpha * self.p(history[1:], word)

    def score(self, tokens):
        line = ["<s>", *tokens]
        return sum(math.log10(self.p(tuple(line[max(0, k + 2 - self.order) : k + 1]), t)) for k, t in enumerate(tokens))


def check(df, texts, order, held):
    tokens = {i: [*words(t.translate(LOWER)), "</s>\n"] for i, t in texts.items()}
    model = Brute([t for i, t in tokens.items() if not held(i)], order)
    vocabulary = len(model.counts[1])
    for r in df.collect():
        t = tokens[r.doc_id]
        c = [model.counts[1][(w,)] for w in t]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(map(bool, c)), model.total)
        assert r.base_score == pytest.approx(sum(math.log10((x + 1) / (model.total + vocabulary + 1)) for x in c), rel=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-9)
    for history in random.Random(1).sample(sorted(model.after, key=str), min(5, len(model.after))):
        whole = sum(model.p(history, w) for (w,) in model.counts[1])
        unseen = model.unknown
        for n in range(len(history)):
            unseen *= model.weight(history[n:])[0]
        assert whole + unseen == pytest.approx(1, abs=1e-9)


def test_documents(spark, documents, texts):
    df = katz.train(documents, held_out=fold(F.col("doc_id"), 7) == 2).score()
    check(df, texts, 2, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_small_texts_in_small_blocks(spark, monkeypatch, order):
    rng = random.Random(order)
    texts = {k: " ".join(rng.choice("aaaabbbccdefghij") for _ in range(rng.randrange(0, 60))) for k in range(80)}
    monkeypatch.setattr(blocks, "PARTITION_KEYS", 500)
    monkeypatch.setattr(katz, "make_blocks", lambda docs, **o: blocks.make_blocks(docs, block_words=200, **o))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    check(katz.train(df, held_out=F.col("doc_id") % 5 == 0, order=order).score(), texts, order, lambda i: i % 5 == 0)


def test_edge_cases(spark, edge_docs):
    rows = katz.train(edge_docs, held_out=fold(F.col("doc_id"), 7) == 2).score().collect()
    assert len(rows) == edge_docs.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}


def test_nothing_to_learn_from(spark, edge_docs, no_docs):
    rows = katz.train(edge_docs, held_out=F.lit(True)).score().collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in rows} == {(0, 0, 0.0)}
    assert katz.train(no_docs, held_out=F.lit(False)).score().collect() == []
