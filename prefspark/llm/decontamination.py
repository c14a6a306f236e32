"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of two cells of CELL words, overlapping by one cell. The benchmark's
passages, weighted by term frequency and inverse frequency over all cells of all documents, are the
rows of a matrix whose leading right singular vectors a randomised SVD finds, in Spark jobs over the
rows; there are as many of them as hold ENERGY of the rows and SHARE of each row. Document passages are
folded into that space. One whose cosine with a benchmark passage is COSINE or more, and whose part
along it is at least PART of its length, is a candidate (the latter as a passage of few weighted words
points anywhere). A candidate's surroundings are then compared with the item by their longest common
subsequence of words: a share of LCS of the item's words or more is a leak, and so is a share of
PARAPHRASE or more if the item's answer is found there as well. A benchmark without an answer column has
no answers to check; the item's last ANSWER_WORDS words then stand in for one, if it has at least twice as
many words, and a paraphrase that changes two of them is not found. Words in over STOP of all cells weigh
nothing, but for items that have few others; they count like any in the comparison of words.

Words are compared in lower case and without punctuation. Texts are read once: they become blocks of word
numbers, each with a vocabulary of its own. The benchmark is taken in slices of at most SLICE_WORDS words,
whose vectors are what tasks get of it, and SLICES of them share a pass over the blocks: one to count, one
to search. What is left out before passages are folded in is bounded exactly: a passage whose words can't
add up to PART along any vector is no candidate.

Defined results
* A null or empty text, in either table, is linked with nothing; nor is an item without words.
* Rows that share a document id, or have none, are one document in `leaks`; likewise for items.
  `decontaminate` judges rows with an id one by one; those without are one document.
* An empty table on either side gives no links. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import array
import bisect
import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import drop_written, written

CELL = 16
ENERGY = 0.9
SHARE = 0.6
COSINE = 0.4
PART = 0.25
STOP = 0.02
#: A benchmark passage with fewer weighted words than this keeps the weights of all its words.
FEW_WORDS = 5
#: Item passages start this many words apart, so that one of them lies close to any passage of a text.
ITEM_STRIDE = CELL // 2
LCS = 0.7
PARAPHRASE = 0.55
ANSWER_WORDS = 5
SLICE_WORDS = 10_000
#: Slices that share a pass over the documents.
SLICES = 8
#: Groups of neighbouring item passages that share a bound.
GROUPS = 32
SEED = 42
BLOCK_WORDS = 1 << 20
LINK = "doc_id long, item_id long, lcs_share double, cosine double, first_word long"
_ENCODED = "ids binary, lengths binary, tokens binary, vocabulary string"
_NO_ID = -(2**63)
_MARKS = re.compile(r"[\W_]+")


def plain_words(text: str | None) -> list[str]:
    return [w for w in (_MARKS.sub("", w) for w in (text or "").lower().split()) if w]


def lcs_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence; a row of the table is the bits of one number."""
    return _lcs(places_of(a), len(a), b)


def places_of(a: list[int]) -> dict[int, int]:
    """For each word of `a` the bits of its places."""
    where: dict[int, int] = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    return where


def _lcs(where: dict[int, int], n: int, b: Iterable[int]) -> int:
    full = (1 << n) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        if hit:  # else the row stays as it is
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def cell_bounds(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of these lengths, one after another: where each cell starts, its text, and whether it
    is the last of its text. The last two cells of a text may be uneven; a text has a cell at least."""
    cells = np.maximum(1, lengths // CELL)
    text = np.repeat(np.arange(len(lengths)), cells)
    within = np.arange(len(text)) - np.repeat(np.cumsum(cells) - cells, cells)
    starts = np.repeat(np.cumsum(lengths) - lengths, cells) + within * CELL
    return starts, text, within == np.repeat(cells, cells) - 1


def _cell_sums(rows: np.ndarray, words: np.ndarray, cell: np.ndarray, cells: int) -> np.ndarray:
    """Sums of the rows of words, which come cell by cell, over each cell."""
    sums = np.zeros((cells, rows.shape[1]), dtype=np.float32)
    filled, first = np.unique(cell, return_index=True)
    for k in range(0, len(filled), 4096):  # so that what is gathered at a time stays small
        low, high = first[k], first[k + 4096] if k + 4096 < len(first) else len(words)
        sums[filled[k : k + 4096]] = np.add.reduceat(rows[words[low:high]], first[k : k + 4096] - low, axis=0)
    return sums


def passage_sums(
    tokens: np.ndarray, lengths: np.ndarray, weighted: np.ndarray, bounds: np.ndarray | None = None, least: float = 0.0
) -> tuple[np.ndarray, ...]:
    """Sums of the rows of `weighted` over the words of each passage: (sums, start, end, text).

    A passage is a cell and the next one of the same text; a text of one cell is one passage. Word 0 has
    no row. With `bounds`, passages over whose words each of its columns adds up to less than `least` are left
    out.
    """
    starts, text, last = cell_bounds(lengths)
    lead = np.flatnonzero(~last | np.concatenate(([True], last[:-1])))
    two = ~last[lead]
    known = np.flatnonzero(tokens)
    cell = np.searchsorted(starts, known, side="right") - 1
    words = tokens[known]
    if bounds is not None:
        most = _cell_sums(bounds, words, cell, len(starts))
        reach = most[lead]
        reach[two] += most[lead[two] + 1]
        near = (reach >= least).any(axis=1)
        lead, two = lead[near], two[near]
        needed = np.zeros(len(starts), dtype=bool)
        needed[lead] = needed[lead[two] + 1] = True
        inside = needed[cell]
        words, cell = words[inside], cell[inside]
    sums = _cell_sums(weighted, words, cell, len(starts))
    passages = sums[lead]
    passages[two] += sums[lead[two] + 1]
    cell_ends = np.append(starts[1:], lengths.sum())
    return passages, starts[lead], cell_ends[lead + two], text[lead]


class Items:
    """A slice of the benchmark: word numbers from 1 on, items and their answers as numbers."""

    def __init__(self, rows: list[tuple[int | None, str, str | None]]):
        self.vocabulary: dict[str, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.ids = [i for i, _, _ in rows]
        self.words = [[number(w) for w in plain_words(text)] for _, text, _ in rows]
        self.answered = [bool(plain_words(answer)) for _, _, answer in rows]
        # Where the benchmark has no answers, an item's last words stand in for them.
        self.answers = [
            [number(w) for w in plain_words(answer)] if answered else words[-ANSWER_WORDS:]
            for (_, _, answer), words, answered in zip(rows, self.words, self.answered, strict=True)
        ]
        self.places = [places_of(words) for words in self.words]
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.tokens = np.array([w for words in self.words for w in words], dtype=np.int64)

    def leak(self, item: int, text: list[int], low: int, high: int) -> tuple[float, int] | None:
        """The best share of the item's words found in order near text[low:high], if that is a leak."""
        words, answer = self.words[item], self.answers[item]
        n = len(words)
        reach = n + n // 4
        common = sum((Counter(words) & Counter(text)).values())
        if common < PARAPHRASE * n:  # more than this no order of the words can give
            return None
        best = (0.0, low)
        where = self.places[item]
        # Words that the item does not have are in no common subsequence.
        shared = [k for k, w in enumerate(text) if w in where]
        common = [text[k] for k in shared]
        for start in range(max(0, low - reach), min(len(text), high + 1), max(1, n // 8)):
            first, end = bisect.bisect_left(shared, start), bisect.bisect_left(shared, start + reach)
            if end - first <= best[0] * n:  # no better than what was found
                continue
            share = _lcs(where, n, common[first:end]) / n
            if share > best[0]:
                best = share, start
        share, start = best
        if share >= LCS:
            return best
        if share >= PARAPHRASE and (self.answered[item] or n >= 2 * ANSWER_WORDS):
            if lcs_length(answer, text[start : start + reach + len(answer)]) >= 0.8 * len(answer):
                return best
        return None


def _slices(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> Iterator[list[tuple]]:
    """Runs of items with at most SLICE_WORDS words or a single item; the driver holds one at a time."""
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    rows, words = [], 0
    chosen = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), answer.alias("a"))
    for row in chosen.where("t is not null").toLocalIterator():
        n = len(plain_words(row.t))
        if not n:
            continue
        if rows and words + n > SLICE_WORDS:
            yield rows
            rows, words = [], 0
        rows.append((row.i, row.t, row.a))
        words += n
    if rows:
        yield rows


def encoded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents as numbers of their words in the block's vocabulary; a written table."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        class Numbers(dict):
            """By word as it stands in a text: the number of its plain form, -1 if that is empty."""

            def __init__(self):
                self.plain: dict[str, int] = {}

            def __missing__(self, word: str) -> int:
                plain = _MARKS.sub("", word.lower())
                self[word] = n = self.plain.setdefault(plain, len(self.plain)) if plain else -1
                return n

        number = Numbers()
        ids, lengths, tokens = [], [], array.array("i")

        def row() -> pd.DataFrame:
            """The block with numbers of its own, for the words that it has."""
            words = np.frombuffer(tokens, dtype=np.int32)
            there = np.zeros(len(number.plain), dtype=bool)
            there[words] = True
            own = (np.cumsum(there, dtype=np.int32) - 1)[words]
            packed = (
                np.array(ids, dtype=np.int64).tobytes(), np.array(lengths, dtype=np.int32).tobytes(), own.tobytes(),
                " ".join(itertools.compress(number.plain, there.tolist())),
            )
            return pd.DataFrame([packed], columns=["ids", "lengths", "tokens", "vocabulary"])

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                found = list(map(number.__getitem__, text.split()))
                if -1 in found:
                    found = [n for n in found if n >= 0]
                ids.append(_NO_ID if doc_id is None else int(doc_id))
                lengths.append(len(found))
                tokens.extend(found)
                if len(tokens) >= BLOCK_WORDS:
                    yield row()
                    ids, lengths, tokens = [], [], array.array("i")
                    if len(number) > 1 << 20:
                        number = Numbers()
        if ids:
            yield row()

    rows = docs.select(
        F.col(id_col).cast("long").cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return written(rows.mapInPandas(encode, _ENCODED), "decontamination-blocks")


class Block:
    """A row of the encoded table."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.lengths = np.frombuffer(row.lengths, dtype=np.int32).astype(np.int64)
        self.own_tokens = np.frombuffer(row.tokens, dtype=np.int32)
        self.vocabulary = row.vocabulary.split(" ")

    def tokens(self, numbers: dict[str, int]) -> np.ndarray:
        """The documents' words by these numbers, zero for words that have none."""
        return np.array([numbers.get(w, 0) for w in self.vocabulary], dtype=np.int32)[self.own_tokens]


def inverse_frequencies(blocks: DataFrame, slices: list[Items], stop: float = STOP) -> list[np.ndarray]:
    """For each slice log(cells / cells with the word) for each word number, over all cells of all documents;
    zero for stop words."""
    vocabularies = [items.vocabulary for items in slices]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [np.zeros(len(v) + 1, dtype=np.int64) for v in vocabularies]
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row)
                starts, _, _ = cell_bounds(block.lengths)
                for counts, numbers in zip(found, vocabularies, strict=True):
                    tokens = block.tokens(numbers)
                    known = np.flatnonzero(tokens)
                    cell = np.searchsorted(starts, known, side="right") - 1
                    # Words in order, and the cells of each in order: sorting 16 bits takes a step per byte.
                    order = np.argsort(tokens[known].astype(np.uint16 if len(counts) <= 1 << 16 else np.uint32), kind="stable")
                    words, cell = tokens[known][order], cell[order]
                    new = np.ones(len(words), dtype=bool)
                    new[1:] = (words[1:] != words[:-1]) | (cell[1:] != cell[:-1])
                    counts += np.bincount(words[new], minlength=len(counts))
                    counts[0] += len(starts)
        for place, counts in enumerate(found):
            yield pd.DataFrame({"slice": place, "word": np.arange(len(counts)), "n": counts})

    counted = blocks.mapInPandas(count, "slice int, word int, n long").groupBy("slice", "word").agg(F.sum("n").alias("n")).collect()
    totals = [np.zeros(len(v) + 1) for v in vocabularies]
    for place, word, value in counted:
        totals[place][word] = value
    return [_weights(items, n, stop) for items, n in zip(slices, totals, strict=True)]


def _weights(items: Items, n: np.ndarray, stop: float) -> np.ndarray:
    idf = np.concatenate(([0.0], np.log((2 + n[0]) / (1 + n[1:]))))
    weighs = n <= stop * n[0]
    for _, low, high in item_passages(items.lengths):
        words = np.unique(items.tokens[low:high])
        if weighs[words].sum() < FEW_WORDS:
            weighs[words] = True
    weighs[0] = False
    return np.where(weighs, idf, 0.0).astype(np.float32)


def item_passages(lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, from, to) for the passages of all items, as places in the items' words one after another."""
    found, begin = [], 0
    for item, n in enumerate(lengths.tolist()):
        last = max(0, n - 2 * CELL)
        for start in sorted({*range(0, last, ITEM_STRIDE), last}):
            found.append((item, begin + start, begin + min(n, start + 2 * CELL)))
        begin += n
    return found


def _drawn(size: int, width: int, seed: int) -> np.ndarray:
    """The random test matrix; each task draws it anew, so that none is sent."""
    return np.random.default_rng(seed).standard_normal((size, width))


def _leading_vectors(y: np.ndarray, test: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, weights: np.ndarray, energy: float, share: float) -> np.ndarray:
    """The singular vectors that `latent_basis` keeps, from the test matrix and A^T A times it."""
    size, width = test.shape
    test, turned = np.linalg.qr(test)
    z = np.linalg.solve(turned.T, y.T).T  # A^T A times the orthonormal one
    shift = 1e-9 * max(np.linalg.norm(z), 1.0)
    z += shift * test
    core = test.T @ z
    del test
    values, turns = np.linalg.eigh((core + core.T) / 2)
    scaled = z @ (turns / np.sqrt(np.maximum(values, shift)))
    del z
    basis, strengths, _ = np.linalg.svd(scaled, full_matrices=False)
    places = item_passages(lengths)
    held = np.zeros((len(places), width))
    for k, (_, low, high) in enumerate(places):
        words, n = np.unique(tokens[low:high], return_counts=True)
        row = n * weights[words]
        held[k] = (row @ basis[words]) ** 2 / max(row @ row, 1e-12)
    enough = (np.cumsum(strengths**2) >= energy * (strengths**2).sum()) & (np.cumsum(held, axis=1).min(axis=0) >= min(share, held.sum(axis=1).min()))
    rank = int(np.argmax(enough)) + 1 if enough.any() else width
    return basis[:, :rank]


def latent_basis(spark, items: Items, idf: np.ndarray, energy=ENERGY, share=SHARE, seed=SEED) -> np.ndarray:
    """The leading right singular vectors of the items' passages, word by word, weighted by idf.

    With a random test matrix T, Spark adds up A^T A T over the rows of A, some passages a task; the
    eigenvectors of A^T A then follow from T and that product alone (Nystroem), in a task too, and the driver
    gets the kept vectors in single precision. Rows have length one.
    A slice of the benchmark has few hundred rows, so T has a column for each and some more.
    """
    places = item_passages(items.lengths)
    size, width = len(idf), min(len(places) + 16, len(idf))
    lengths, tokens, weights = items.lengths, items.tokens, idf.astype(float)

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        test = _drawn(size, width, seed)
        total = np.zeros((size, width))
        for batch in batches:
            for packed in batch["words"]:
                words, n = np.unique(np.frombuffer(packed, dtype=np.int64), return_counts=True)
                row = n * weights[words]
                total[words] += np.outer(row, row @ test[words]) / max(row @ row, 1e-12)
        yield pd.DataFrame([(k, total[k : k + 4096].tobytes()) for k in range(0, size, 4096)], columns=["at", "part"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        parts = sum(np.frombuffer(p) for p in group["part"])
        return pd.DataFrame([(0, int(group["at"].iloc[0]), parts.tobytes())], columns=["slice", "at", "part"])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        y = np.concatenate([np.frombuffer(p).reshape(-1, width) for _, p in sorted(zip(group["at"], group["part"], strict=True))])
        basis = _leading_vectors(y, _drawn(size, width, seed), lengths, tokens, weights, energy, share)
        return pd.DataFrame([((basis * weights[:, None]).astype(np.float32).tobytes(),)], columns=["basis"])

    passages = [(items.tokens[low:high].tobytes(),) for _, low, high in places]
    rows = spark.createDataFrame(passages, "words binary").repartition(min(len(passages) // 100 + 1, 200))
    parts = rows.mapInPandas(product, "at int, part binary").groupBy("at").applyInPandas(add, "slice int, at int, part binary")
    kept = parts.groupBy("slice").applyInPandas(finish, "basis binary").first().basis
    return np.frombuffer(kept, dtype=np.float32).reshape(size, -1)


class Index:
    """What tasks get of a slice to search it."""

    def __init__(self, items: Items, basis: np.ndarray, idf: np.ndarray):
        places = item_passages(items.lengths)
        self.items, self.basis, self.heavy = items, basis, idf > 0
        self.vectors = np.stack([basis[items.tokens[low:high]].sum(axis=0) for _, low, high in places])
        self.sizes = np.linalg.norm(self.vectors, axis=1)
        self.whole = np.array([((np.bincount(items.tokens[low:high], minlength=len(idf)) * idf) ** 2).sum() for _, low, high in places])
        self.owner = np.array([item for item, _, _ in places])
        # Of each word, the greatest part that it can add along a vector of each group, for passages that can't
        # reach `part` along any vector need not be folded in.
        groups = np.array_split(np.arange(len(places)), min(GROUPS, len(places)))
        gains = lambda group: basis @ self.vectors[group].T / self.whole[group].astype(np.float32)
        self.bounds = np.stack([gains(group).max(axis=1) for group in groups], axis=1)

    def candidates(self, tokens: np.ndarray, lengths: np.ndarray, cosine: float, part: float) -> Iterator[tuple[int, int, int, float]]:
        """(text, start among the words of all texts, item, cosine) for passages near an item's."""
        weighing = np.where(self.heavy[tokens], tokens, 0)
        # A little less than `part`, as sums are rounded.
        passages, starts, _, text = passage_sums(weighing, lengths, self.basis, self.bounds, part * 0.999)
        for k in range(0, len(passages), 8192):
            rows = passages[k : k + 8192]
            along = rows @ self.vectors.T
            for p, q in np.argwhere(along >= part * self.whole).tolist():
                near = float(along[p, q] / (np.linalg.norm(rows[p]) * self.sizes[q]))
                if near >= cosine:
                    yield int(text[k + p]), int(starts[k + p]), int(self.owner[q]), near


def _search(blocks: DataFrame, indexes: list[Index], cosine: float, part: float) -> DataFrame:
    """Links found in each block: candidates by cosine, then the check of words and answers."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row)
                begins = np.cumsum(block.lengths) - block.lengths
                for index in indexes:
                    items, found = index.items, {}
                    tokens = block.tokens(items.vocabulary)
                    for doc, start, item, near in index.candidates(tokens, block.lengths, cosine, part):
                        at, n = start - int(begins[doc]), int(items.lengths[item])
                        low, high = max(0, at - 3 * n), at + 2 * CELL + 3 * n
                        words = tokens[begins[doc] : begins[doc] + block.lengths[doc]]
                        leak = items.leak(item, words[low:high].tolist(), at - low, at - low + 2 * CELL)
                        if leak and (leak[0], near) > found.get((doc, item), (0.0, 0.0))[:2]:
                            found[doc, item] = leak[0], near, low + leak[1]
                    yield pd.DataFrame(
                        [(block.ids[d], items.ids[i], share, near, at) for (d, i), (share, near, at) in found.items()],
                        columns=["doc_id", "item_id", "lcs_share", "cosine", "first_word"],
                    ).astype({"item_id": "Int64"})

    return blocks.mapInPandas(search, LINK)


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, cosine=COSINE, part=PART, seed=SEED, doc_id_col="doc_id",
    item_id_col="item_id", text_col="text", answer_col: str | None = None,
) -> DataFrame:
    """One row per document and item of which it holds most words in order, with the place of the match."""
    spark, found, blocks = docs.sparkSession, None, None
    slices = map(Items, _slices(benchmark, item_id_col, text_col, answer_col))
    while some := list(itertools.islice(slices, SLICES)):
        blocks = encoded(docs, doc_id_col, text_col) if blocks is None else blocks
        weights = inverse_frequencies(blocks, some)
        indexes = [Index(items, latent_basis(spark, items, idf, seed=seed), idf) for items, idf in zip(some, weights, strict=True)]
        links = written(_search(blocks, indexes, cosine, part), "leaks")
        found = links if found is None else found.unionByName(links)
    if blocks is not None:
        drop_written(blocks)
    if found is None:
        return spark.createDataFrame([], LINK)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs_share", "cosine", -F.col("first_word"))).alias("m"))
    doc_id = F.when(F.col("doc_id") != _NO_ID, F.col("doc_id"))
    return best.select(doc_id.alias("doc_id"), "item_id", "m.lcs_share", "m.cosine", (-F.col("m.col3")).alias("first_word"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The documents that hold no benchmark item.

    A row with an id is judged by its own text, also where others share the id; its key is a hash of both,
    so that reruns agree. Rows without an id are one document.
    """
    number, text = F.col(doc_id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    row = F.when(number.isNotNull(), F.xxhash64(number, text)).alias("row")
    keyed = docs.select(F.struct("*").alias("doc"), row, text.alias(text_col))
    found = leaks(keyed.select("row", text_col), benchmark, doc_id_col="row", text_col=text_col, **options)
    held = written(found.select(F.col("doc_id").alias("leaking")).distinct(), "leaking")
    return keyed.join(held, F.col("row").eqNullSafe(F.col("leaking")), "left_anti").select("doc.*")
