"""SimHash near-duplicates by anchor-point covering.

A fingerprint of 64 bits is cut into pieces so that two within the threshold differ in at most one bit
of some piece. On each piece a covering code of radius 1 (a Hamming code times all values of the bits
left over) gives the anchors. A fingerprint is at home at its nearest anchor and is copied to all
anchors within the covering radius plus one; so of two that differ in at most one bit of the piece,
each is copied to the home of the other. Every anchor compares those at home with all its copies.

Equal fingerprints are one throughout. An anchor gives at most one link per fingerprint (to the root of
what it found connected), never all pairs, and no link between different fingerprints is lost to the
components. Anchors with very many copies have those at home dealt to several tasks.

Defined results
* A null or empty text has the fingerprint zero, which is linked like any other.
* The component of a document is its smallest id; ids that are null do not count unless all are.
* Repeated rows give repeated rows. An empty table gives an empty result.
* Output columns replace input columns of the same name in `near_dedup`; other columns are carried.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm import jaccard
from prefspark.llm.common import without, written
from prefspark.llm.components import components

BITS = 64
SHINGLE = 4
MAX_BITS = 4
SIMILARITY = 0.8
SEED = 42
#: Copies at one anchor above which those at home are dealt to several tasks.
HOT_ANCHOR = 50_000
_CHUNK = 1 << 16


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """The hashes of the text's shingles, in parts."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    while part := list(itertools.islice(spans, _CHUNK)):
        yield np.array([digest(joined[a:b], seed) for a, b in part], dtype="<u8")


def _print_of(parts: list[np.ndarray]) -> int:
    n, ones = sum(map(len, parts)), np.zeros(BITS, dtype=np.int64)
    for hashes in parts:
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist())


def _set_of(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, dtype="<u8"), *parts]))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is one if it is in over half of the hashes of the text's shingles."""
    return _print_of(list(shingle_hashes(text, shingle, seed)))


def fingerprints(docs: DataFrame, *, shingle=SHINGLE, seed=SEED, text_col="text") -> DataFrame:
    """The documents with `simhash`, a 64-bit number in two's complement."""

    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return docs.select(*without(docs, "simhash"), F.pandas_udf(of, "long")(F.col(text_col)).alias("simhash"))


class Covering:
    """Anchors on one piece of the fingerprint: a Hamming code on its low bits, every value on the rest."""

    def __init__(self, shift: int, width: int):
        self.shift, self.width = shift, width
        self.coded = 15 if width >= 15 else 7
        if width < 7:
            raise ValueError("too many differing bits for pieces of a useful width")
        # By syndrome: flips of at most two coded bits that lead to a codeword, and how many bits they are.
        self.flips: list[list[tuple[int, int]]] = [[] for _ in range(self.coded + 1)]
        for size in range(3):
            for bits in itertools.combinations(range(self.coded), size):
                syndrome = 0
                for b in bits:
                    syndrome ^= b + 1
                self.flips[syndrome].append((sum(1 << b for b in bits), size))
        free = [1 << b for b in range(self.coded, width)]
        self.free = [[0], [0, *free], [0, *free, *(a | b for a, b in itertools.combinations(free, 2))]]

    def piece(self, prints: np.ndarray) -> np.ndarray:
        return (prints >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)

    def syndrome(self, pieces: np.ndarray) -> np.ndarray:
        s = np.zeros(len(pieces), dtype=np.int64)
        for b in range(self.coded):
            s ^= np.where((pieces >> np.uint64(b)) & np.uint64(1), b + 1, 0)
        return s

    def anchors(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the fingerprint, anchor, whether it is its home) for all copies."""
        pieces = self.piece(prints)
        syndromes = self.syndrome(pieces)
        where, anchors, homes = [], [], []
        for s in range(self.coded + 1):
            at = np.flatnonzero(syndromes == s)
            home = 1 << (s - 1) if s else 0
            moves = [(flip | f, flip == home and f == 0) for flip, size in self.flips[s] for f in self.free[2 - size]]
            for move, is_home in moves:
                where.append(at)
                anchors.append(pieces[at] ^ np.uint64(move))
                homes.append(np.full(len(at), is_home))
        return np.concatenate(where), np.concatenate(anchors).astype(np.int64), np.concatenate(homes)


def coverings(max_bits: int) -> list[Covering]:
    """As few pieces as let one of them have at most one differing bit."""
    n = max_bits // 2 + 1
    cuts = [round(k * BITS / n) for k in range(n + 1)]
    return [Covering(a, b - a) for a, b in itertools.pairwise(cuts)]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest connected place of each of n places, by spreading minima and jumping."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def _links_at(prints: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links found at one anchor: each fingerprint to the root of its part."""
    at_home = np.flatnonzero(home)
    found_a, found_b = [], []
    step = max(1, (1 << 22) // max(len(prints), 1))
    for k in range(0, len(at_home), step):
        rows = at_home[k : k + step]
        a, b = np.nonzero(np.bitwise_count(prints[rows][:, None] ^ prints[None, :]) <= max_bits)
        a = rows[a]
        apart = a != b
        found_a.append(a[apart])
        found_b.append(b[apart])
        if sum(map(len, found_a)) > 1 << 22:  # keep what is connected, not every pair
            root = _roots(len(prints), np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b = [np.flatnonzero(root != np.arange(len(root)))], [root[root != np.arange(len(root))]]
    if not found_a or not sum(map(len, found_a)):
        return prints[:0], prints[:0]
    root = _roots(len(prints), np.concatenate(found_a), np.concatenate(found_b))
    moved = np.flatnonzero(root != np.arange(len(root)))
    return prints[moved], prints[root[moved]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, hot_anchor: int = HOT_ANCHOR) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in `simhash` whose parts are those of all links."""
    codes = coverings(max_bits)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k, code in enumerate(codes):
                where, anchors, homes = code.anchors(prints)
                columns = [anchors + (k << 40), prints[where].view(np.int64), homes]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "simhash", "home"])

    copies = distinct.select("simhash").mapInArrow(copy, "anchor long, simhash long, home boolean")
    sizes = copies.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_anchor)
    hot = written(sizes.select("anchor", F.ceil(F.col("n") / hot_anchor).cast("int").alias("shares")), "hot-anchors")
    # Those at home are dealt to the shares of a hot anchor; every share gets all the copies.
    dealt = copies.join(hot, "anchor", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    share = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    dealt = dealt.select("anchor", "simhash", "home", "shares", share)
    mine = F.pmod(F.xxhash64("simhash"), F.col("shares")) == F.col("share")
    dealt = dealt.select("anchor", "share", "simhash", (F.col("home") & mine).alias("home"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of (anchor, share); a group may go on in the next batch."""
        rest: list[np.ndarray] | None = None

        def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
            return [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]

        def found(data: list[np.ndarray]) -> pa.RecordBatch:
            anchor, number, prints, home = data
            edges = np.flatnonzero((anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])) + 1
            a, b = [], []
            for low, high in itertools.pairwise([0, *edges.tolist(), len(anchor)]):
                if high - low > 1 and home[low:high].any():
                    x, y = _links_at(prints[low:high].view(np.uint64), home[low:high].astype(bool), max_bits)
                    a.append(x.view(np.int64))
                    b.append(y.view(np.int64))
            join = lambda parts: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))
            return pa.RecordBatch.from_arrays([join(a), join(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            data = columns(batch)
            if rest is not None:
                data = [np.concatenate(pair) for pair in zip(rest, data, strict=True)]
            anchor, number = data[0], data[1]
            last = np.flatnonzero((anchor != anchor[-1]) | (number != number[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield found([c[:cut] for c in data])
            rest = [c[cut:] for c in data]
        if rest is not None:
            yield found(rest)

    gathered = dealt.repartition("anchor", "share").sortWithinPartitions("anchor", "share")
    return gathered.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, *, shingle=SHINGLE, max_bits=MAX_BITS, seed=SEED, id_col="doc_id", text_col="text",
) -> DataFrame:
    """One row per document: `doc_id`, `simhash` and `component_id`, the smallest id it is linked with."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = written(fingerprints(rows, shingle=shingle, seed=seed).select("doc_id", "simhash"), "simhash")
    distinct = written(prints.groupBy("simhash").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    labels = components(written(links(distinct, max_bits), "simhash-links"))
    labelled = distinct.join(labels, distinct["simhash"] == labels["node"], "left").select(
        "simhash", "least", F.coalesce("label", "simhash").alias("label")
    )
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = written(labelled.join(ids, "label").select("simhash", "component_id"), "simhash-components")
    return prints.join(by_print, "simhash").select("doc_id", "simhash", "component_id")


def near_dedup(
    docs: DataFrame, *, shingle=SHINGLE, max_bits=MAX_BITS, similarity=SIMILARITY, seed=SEED, id_col="doc_id", text_col="text",
) -> DataFrame:
    """The document with the smallest id of each component; rows without an id stay.

    Links are those whose sets of shingles have a Jaccard similarity of `similarity` or more, which the
    sets confirm; candidates come from the fingerprints and from the bands of `jaccard`. Of rows that
    repeat the smallest id within a component, one stays.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("t"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, prints, keys = [], [], []
            for value in batch.column(2).to_pylist():
                parts = list(shingle_hashes(value, shingle, seed))
                held = _set_of(parts)
                names.append(jaccard.name(held))
                prints.append(_print_of(parts))
                keys.append(jaccard.bands(held))
            columns = [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (names, prints)]
            columns += [pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "text", "set", "simhash", "bands"])

    marked = keyed.select("id", "key", "t").mapInArrow(mark, "id long, text long, set long, simhash long, bands array<long>")
    marks = written(marked, "near-marks")
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text"))).alias("least")
    grouped = marks.groupBy("set").agg(least, F.min("text").alias("text"), F.min("simhash").alias("simhash"), F.first("bands").alias("bands"))
    distinct = written(grouped, "near-distinct")

    def sets_of(needed: DataFrame) -> DataFrame:
        wanted = distinct.join(needed, "set").select("set", F.col("text").alias("key"))
        texts = keyed.select("key", "t").join(wanted, "key").select("set", "t").dropDuplicates(["set"])

        def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = [_set_of(list(shingle_hashes(value, shingle, seed))) for value in batch.column(1).to_pylist()]
                columns = [batch.column(0), pa.array([len(h) for h in held], pa.int32()), pa.array([h.tobytes() for h in held], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["set", "n", "shingles"])

        return texts.mapInArrow(shingles, "set long, n int, shingles binary")

    # A fingerprint is one of its sets; the others are candidates with it.
    prints = written(distinct.groupBy("simhash").agg(F.min("set").alias("of")), "near-prints")
    near = links(prints, max_bits).join(prints.toDF("a", "of_a"), "a").join(prints.toDF("b", "of_b"), "b")
    same = distinct.join(prints, "simhash").where("set <> of")
    more = near.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).unionByName(same.select(F.col("set").alias("a"), F.col("of").alias("b")))
    labels = jaccard.linked_components(distinct.select("set", "bands"), more, sets_of, similarity)
    labelled = distinct.join(labels, distinct["set"] == labels["node"], "left").select(F.coalesce("label", "set").alias("label"), "least")
    firsts = labelled.groupBy("label").agg(F.min("least").alias("least")).where("least is not null")
    kept = written(firsts.select(F.col("least.id").alias("id"), F.col("least.text").alias("key")), "simhash-kept")
    unique = keyed.join(kept, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    return unique.unionByName(keyed.where("id is null")).select("doc.*")
