"""Katz backoff language model: training and scoring of a corpus.

A token's probability given its history is d(c) c / norm if the training texts have the n-gram (c times),
else alpha times its probability given the history without its first word. d is the Good-Turing discount
for counts up to K, `norm` the history's count, and alpha makes the probabilities of each history sum to
one exactly: what the discounts free, over one minus the lower-order probability of the words seen after
it. Words that training lacks share what the unigram discounts free, as one word of the vocabulary.

Texts are blocks, and n-grams and histories are keys that blocks ask about (see `blocks`): partitions
count n-grams over all blocks, and partitions of histories add up what the blocks that own their n-grams
(the first to hold each) send. The counts and weights are written tables, partitioned by key.

Where a history has no count up to K, nothing is freed; then its count is taken one larger. Where the
Good-Turing discount of a count is not between 0 and 1 (few data), (c - 1/2) / c takes its place.

Defined results
* A null or empty text is one token, the end. Repeated rows are texts of their own.
* Without training texts every token is unknown and scores log10(1).
* An empty table gives an empty result. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.blocks import (
    MODEL, NO_ID, Block, answers_by_step, ask, attach, joined_names, look_up, make_blocks, pack_small, pack_sorted, part_bounds,
    partitions_for, questions, summed, unpack_small, unpack_sorted,
)

ORDER = 2
#: Counts up to this are discounted.
K = 5
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_BEGIN, _END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Level:
    """What is known of one order: counts of counts 1..K+1, distinct n-grams, n-grams."""

    counts: tuple[float, ...]
    distinct: float
    total: float

    def discounts(self) -> np.ndarray:
        """d(c) for c = 0..K; above it is 1."""
        n = self.counts
        d = np.ones(K + 1)
        rest = (K + 1) * n[K] / n[0] if n[0] else 1.0
        for c in range(1, K + 1):
            good = ((c + 1) * n[c] / (c * n[c - 1]) - rest) / (1 - rest) if n[c - 1] and rest != 1 else 0.0
            d[c] = good if 0 < good < 1 else (c - 0.5) / c
        return d

    def discount(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= K, self.discounts()[np.minimum(counts, K)], 1.0)


class Unigrams:
    """Probabilities of single words; `end` training texts each add one end to the words' counts."""

    def __init__(self, words: Level, texts: int):
        counts = list(words.counts)
        if 0 < texts <= K + 1:
            counts[texts - 1] += 1
        self.level = Level(tuple(counts), words.distinct + (texts > 0), words.total + texts)
        freed = sum((1 - d) * c * n for c, (d, n) in enumerate(zip(self.level.discounts(), (0, *counts), strict=False)))
        # With no rare words nothing is freed; unknown words then count as one token.
        self.norm = self.level.total + (freed == 0)
        self.unknown = freed / self.norm if freed else 1 / self.norm

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.level.discount(counts) * counts / self.norm, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.level.total + self.level.distinct + 1))


class Scorer:
    """The tokens of a block and, order by order, their probabilities."""

    def __init__(self, block: Block, replies: dict[int, list[bytes]], parts: int, texts: int):
        self.block, self.replies, self.parts, self.texts = block, replies, parts, texts
        n_docs = len(block.ids)
        self.lengths = block.lengths + 1
        last = np.cumsum(self.lengths) - 1
        is_word = np.ones(int(self.lengths.sum()), dtype=bool)
        is_word[last] = False
        self.first = np.zeros(len(is_word), dtype=bool)
        self.first[last - self.lengths + 1] = True
        self.is_word = is_word
        self.current = np.full(len(is_word), _END)
        self.current[is_word] = block.names
        self.place = np.arange(len(is_word)) - np.repeat(last - self.lengths + 1, self.lengths)
        self.training = ~np.repeat(block.flags, self.lengths)
        self.document = np.repeat(np.arange(n_docs), self.lengths)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted names of the block's words, and their training counts in it."""
        order = np.argsort(self.block.vocabulary_names)
        of_word = self.training[self.is_word]
        counts = np.bincount(self.block.tokens[of_word], minlength=len(order))
        return self.block.vocabulary_names[order], counts[order]

    def word_counts(self) -> np.ndarray:
        """The training count of each token."""
        order = np.argsort(self.block.vocabulary_names)
        of_name = np.zeros(len(order), dtype=np.int64)
        of_name[order] = _numbers(self.replies.get(0, []))
        counts = np.full(len(self.current), self.texts, dtype=np.int64)
        counts[self.is_word] = of_name[self.block.tokens]
        return counts

    def histories(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the order - 1 symbols before each token, and whether a text has so many there."""
        before = np.empty_like(self.current)
        before[1:] = self.current[:-1]
        before[self.first] = _BEGIN
        history = before
        for _ in range(order - 2):
            longer = np.empty_like(history)
            longer[1:] = joined_names(history[:-1], self.current[:-1], 101)
            longer[:1] = _BEGIN
            history = longer
        return history, self.place >= order - 2

    def grams(self, order: int):
        """Of the n-grams of an order: sorted distinct names, where each is found first, where each token's is."""
        history, there = self.histories(order)
        at = np.flatnonzero(there)
        names = joined_names(history[at], self.current[at], 101)
        distinct, first, place = np.unique(names, return_index=True, return_inverse=True)
        return history, at, distinct, at[first], place

    def probabilities(self, unigrams: Unigrams, levels: list[Level]) -> np.ndarray:
        """Of each token, by the orders whose levels are given."""
        p = unigrams.probability(self.word_counts())
        for order, level in enumerate(levels, 2):
            history, at, distinct, _, place = self.grams(order)
            counts, _ = _gram_reply(self.replies.get(2 * order - 3, []), part_bounds(distinct, self.parts))
            counts = counts[place]
            keys, where = np.unique(history[at], return_inverse=True)
            weights = _context_reply(self.replies.get(2 * order - 2, []), part_bounds(keys, self.parts))
            alpha, norm = weights[0][where], weights[1][where]
            with np.errstate(divide="ignore", invalid="ignore"):
                p[at] = np.where(counts > 0, level.discount(counts) * counts / norm, alpha * p[at])
        return p


def _numbers(payloads: list[bytes]) -> np.ndarray:
    return np.concatenate([unpack_small(p) for p in payloads]) if payloads else np.zeros(0, dtype=np.uint32)


def _count_words(blocks: np.ndarray, payloads: list[bytes]) -> Iterator[tuple]:
    yield from _counted(blocks, payloads, owners=False)


def _count_grams(blocks: np.ndarray, payloads: list[bytes]) -> Iterator[tuple]:
    yield from _counted(blocks, payloads, owners=True)


def _counted(blocks: np.ndarray, payloads: list[bytes], owners: bool) -> Iterator[tuple]:
    """Adds up the counts of each key; tells every block its keys' counts, and which of them it owns."""
    sizes = [len(p) // 12 for p in payloads]
    keys = np.concatenate([unpack_sorted(p[: 8 * n]) for p, n in zip(payloads, sizes, strict=True)])
    counts = np.concatenate([unpack_small(p[8 * n :]) for p, n in zip(payloads, sizes, strict=True)])
    distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
    owned = np.zeros(len(keys), dtype=bool)
    owned[first] = total > 0
    told, at = total[place], 0
    for block, n in zip(blocks, sizes, strict=True):
        here = slice(at, at + n)
        yield block, pack_small(told[here]) + (np.packbits(owned[here]).tobytes() if owners else b""), None
        at += n
    seen = total > 0
    by_count = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2]
    stats = [*by_count.astype(float).tolist(), float(seen.sum()), float(total.sum())]
    yield MODEL, pack_sorted(distinct[seen]) + pack_small(total[seen]), stats


def _gram_reply(payloads: list[bytes], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = [n for n in np.diff(bounds).tolist() if n]
    counts = [unpack_small(p[: 4 * n]) for p, n in zip(payloads, sizes, strict=True)]
    owned = [np.unpackbits(np.frombuffer(p[4 * n :], dtype=np.uint8), count=n) for p, n in zip(payloads, sizes, strict=True)]
    if not payloads:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    return np.concatenate(counts).astype(np.int64), np.concatenate(owned).astype(bool)


def _weigh_contexts(blocks: np.ndarray, payloads: list[bytes]) -> Iterator[tuple]:
    """Backoff weight and norm of each history from what the owners of its n-grams sent."""
    sizes = [len(p) // 32 for p in payloads]
    keys = np.concatenate([unpack_sorted(p[: 8 * n]) for p, n in zip(payloads, sizes, strict=True)])
    sums = [np.frombuffer(p[8 * n :]).reshape(3, n) for p, n in zip(payloads, sizes, strict=True)]
    distinct, place = np.unique(keys, return_inverse=True)
    freed, total, lower = (np.bincount(place, weights=w, minlength=len(distinct)) for w in np.concatenate(sums, axis=1))
    norm = total + (freed == 0)
    freed = np.where(freed == 0, 1.0, freed)
    # A history that training lacks leaves the lower order as it is.
    alpha = np.where(total > 0, freed / norm / np.maximum(1 - lower, 1e-300), 1.0)
    at = 0
    for block, n in zip(blocks, sizes, strict=True):
        here = place[at : at + n]
        yield block, alpha[here].tobytes() + norm[here].tobytes(), None
        at += n
    seen = total > 0
    yield MODEL, pack_sorted(distinct[seen]) + alpha[seen].tobytes() + norm[seen].tobytes(), None


def _context_reply(payloads: list[bytes], bounds: np.ndarray) -> np.ndarray:
    parts = [np.frombuffer(p).reshape(2, -1) for p in payloads]
    return np.concatenate(parts, axis=1) if parts else np.zeros((2, 0))


def _keys(block: Block, names: np.ndarray, parts: int) -> list[tuple]:
    return questions(block.number, names, parts, lambda s: pack_sorted(names[s]))


def _found(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys stand in a sorted table, and whether they do."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


def _told_counts(keys: np.ndarray, model: bytes | None, owners: bool = False) -> bytes:
    raw = model or b""
    n = len(raw) // 12
    place, there = _found(keys, unpack_sorted(raw[: 8 * n]) if n else np.zeros(0, dtype=np.uint64))
    counts = np.where(there, unpack_small(raw[8 * n :])[place], 0) if n else np.zeros(len(keys), dtype=np.int64)
    return pack_small(counts) + (np.packbits(there).tobytes() if owners else b"")


def _told_grams(keys: np.ndarray, model: bytes | None) -> bytes:
    return _told_counts(keys, model, owners=True)


def _told_weights(keys: np.ndarray, model: bytes | None) -> bytes:
    raw = model or b""
    n = len(raw) // 24
    if not n:
        return np.ones(2 * len(keys)).tobytes()
    place, there = _found(keys, unpack_sorted(raw[: 8 * n]))
    alpha, norm = np.frombuffer(raw[8 * n :]).reshape(2, n)
    return np.where(there, alpha[place], 1.0).tobytes() + np.where(there, norm[place], 1.0).tobytes()


@dataclass
class KatzModel:
    """A trained model with the blocks it was trained on.

    `tables` are the written tables of counts and weights: rows with block = MODEL hold, by step (0 words,
    then n-grams and histories of each order) and key partition, sorted keys and their values.
    """

    blocks: DataFrame
    tables: DataFrame
    parts: int
    unigrams: Unigrams
    levels: list[Level]
    texts: int

    def score(self) -> DataFrame:
        """Scores of all texts of the blocks, held out or not, by what the blocks were told in training."""
        return self._scored(self.blocks, self.tables)

    def score_texts(self, docs: DataFrame, *, held_out: Column | None = None, id_col="doc_id", text_col="text") -> DataFrame:
        """Scores of any texts, by the stored tables: each order's counts, and the weights of histories, are
        looked up by key. A key that no table has counts zero, and its history leaves the lower order as
        it is."""
        parts, texts = self.parts, self.texts
        blocks = make_blocks(docs, lower=True, flag=held_out, id_col=id_col, text_col=text_col)

        def words_of(block: Block, replies, parts: int) -> list[tuple]:
            return _keys(block, Scorer(block, replies, parts, texts).words()[0], parts)

        answers = look_up(blocks, self.tables, 0, parts, words_of, _told_counts, "katz-scored-words")
        for n in range(2, len(self.levels) + 2):

            def grams_of(block: Block, replies, parts: int, n=n) -> list[tuple]:
                return _keys(block, Scorer(block, replies, parts, texts).grams(n)[2], parts)

            def histories_of(block: Block, replies, parts: int, n=n) -> list[tuple]:
                scorer = Scorer(block, replies, parts, texts)
                history, there = scorer.histories(n)
                return _keys(block, np.unique(history[there]), parts)

            for step, question, reply in ((2 * n - 3, grams_of, _told_grams), (2 * n - 2, histories_of, _told_weights)):
                told = look_up(blocks, self.tables, step, parts, question, reply, f"katz-scored-{step}")
                answers = answers.unionByName(told)
        return self._scored(blocks, answers)

    def _scored(self, blocks: DataFrame, tables: DataFrame) -> DataFrame:
        parts, texts, unigrams, levels = self.parts, self.texts, self.unigrams, self.levels

        def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    block = Block(row)
                    scorer = Scorer(block, answers_by_step(row), parts, texts)
                    counts = scorer.word_counts()
                    n = len(block.ids)
                    add = lambda values: np.bincount(scorer.document, weights=values, minlength=n)  # noqa: E731, B023
                    yield pd.DataFrame({
                        "doc_id": pd.array([None if i == NO_ID else i for i in block.ids.tolist()], dtype="Int64"),
                        "held_out": block.flags, "n_tokens": scorer.lengths,
                        "n_known": add(counts > 0).astype(np.int64), "train_tokens": int(unigrams.level.total),
                        "base_score": add(unigrams.base(counts)),
                        "score": add(np.log10(scorer.probabilities(unigrams, levels))),
                    })

        return attach(blocks, tables).mapInPandas(finish, RESULT)


def train(docs: DataFrame, *, held_out: Column, order=ORDER, id_col="doc_id", text_col="text") -> KatzModel:
    """A model of the texts that are not held out. Words are lower-cased (A-Z) runs without blanks."""
    blocks = make_blocks(docs, lower=True, flag=held_out, id_col=id_col, text_col=text_col)
    texts = docs.where(~held_out).count()
    parts = partitions_for(blocks)

    def ask_words(block: Block, replies, parts: int) -> list[tuple]:
        names, counts = Scorer(block, replies, parts, texts).words()
        return questions(block.number, names, parts, lambda s: pack_sorted(names[s]) + pack_small(counts[s]))

    tables = ask(blocks, None, 0, parts, ask_words, _count_words, "katz-words")
    *counts, distinct, total = summed(tables) or [0.0] * (K + 3)
    unigrams, levels = Unigrams(Level(tuple(counts), distinct, total), texts) if texts else _untrained(), []
    for n in range(2, order + 1):
        known = list(levels)

        def ask_grams(block: Block, replies, parts: int, n=n) -> list[tuple]:
            scorer = Scorer(block, replies, parts, texts)
            _, at, names, _, place = scorer.grams(n)
            counts = np.bincount(place, weights=scorer.training[at], minlength=len(names))
            return questions(block.number, names, parts, lambda s: pack_sorted(names[s]) + pack_small(counts[s]))

        told = ask(blocks, tables, 2 * n - 3, parts, ask_grams, _count_grams, f"katz-{n}-grams")
        *counts, distinct, total = summed(told) or [0.0] * (K + 3)
        level = Level(tuple(counts), distinct, total)
        tables = tables.unionByName(told)

        def ask_contexts(block: Block, replies, parts: int, n=n, level=level, known=known) -> list[tuple]:
            scorer = Scorer(block, replies, parts, texts)
            history, at, names, first, _ = scorer.grams(n)
            counts, owned = _gram_reply(replies.get(2 * n - 3, []), part_bounds(names, parts))
            keys = np.unique(history[at])
            mine, counts = first[owned], counts[owned]
            where = np.searchsorted(keys, history[mine])
            lower = scorer.probabilities(unigrams, known)[mine]
            add = lambda values: np.bincount(where, weights=values, minlength=len(keys))
            sums = np.stack([add((1 - level.discount(counts)) * counts), add(counts), add(lower)])
            return questions(block.number, keys, parts, lambda s: pack_sorted(keys[s]) + sums[:, s].tobytes())

        told = ask(blocks, tables, 2 * n - 2, parts, ask_contexts, _weigh_contexts, f"katz-{n}-contexts")
        tables, levels = tables.unionByName(told), [*known, level]
    return KatzModel(blocks, tables, parts, unigrams, levels, texts)


def _untrained() -> Unigrams:
    empty = Unigrams(Level((0.0,) * (K + 1), 0.0, 0.0), 0)
    empty.unknown = 1.0
    return empty
