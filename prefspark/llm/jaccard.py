"""Links between sets of shingles whose Jaccard similarity reaches a threshold, confirmed by the sets.

Candidates share the smallest values of ROWS permutations (MinHash) in one of BANDS bands. Two sets of
similarity s share none of them with chance (1 - s**ROWS)**BANDS, which is 1e-11 at 0.8; links found
elsewhere may be added. Every candidate is compared by the sets themselves, so no link is below the
threshold.

First, members of a bucket are compared with its smallest and its largest set, which connects most of a
crowd without its pairs. What is then still apart in a bucket is brought together, and each set is
compared with all those of other components, so that the components are those of all links. Crowded
buckets are dealt to several tasks, one for each two shares of the members.

A set is named by a 64-bit hash of its shingles' hashes; equal sets are one throughout.

Defined results
* Sets without shingles are all equal, and so one set; they are linked with no other.
* Repeated sets and candidates do not matter; a set without links has no row among the components.
* No sets give no links. Columns other than those named are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import written
from prefspark.llm.components import components

ROWS = 4
BANDS = 48
#: Members of a bucket above which they are dealt to shares.
CROWD = 500
_CHUNK = 1 << 12
_DRAWN = np.random.default_rng(42)
_FACTORS = _DRAWN.integers(0, 2**32, ROWS * BANDS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _DRAWN.integers(0, 2**32, ROWS * BANDS, dtype=np.uint32)
_MIX = _DRAWN.integers(0, 2**64, (ROWS, BANDS), dtype=np.uint64) | np.uint64(1)


def name(hashes: np.ndarray) -> int:
    """The name of a set of distinct sorted hashes."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key per band of a set of distinct hashes; the empty set has none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(ROWS * BANDS, 2**32 - 1, dtype=np.uint32)
    for k in range(0, len(short), _CHUNK):
        values = short[k : k + _CHUNK, None] * _FACTORS
        values += _SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    mixed = (least.reshape(ROWS, BANDS).astype(np.uint64) + np.uint64(1)) * _MIX
    keys = mixed[0]
    for row in mixed[1:]:
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + row
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(len(a) + len(b) - common, 1)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of set names that reach the similarity."""
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("of_a"), F.col("n").alias("n_a"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("of_b"), F.col("n").alias("n_b"))
    fits = F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-6
    sizes = sets.select("set", "n")
    sized = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").where(fits).select("a", "b")
    both = sized.join(left.drop("n_a"), "a").join(right.drop("n_b"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b = (batch.column(k).to_pylist() for k in (2, 3))
            near = [
                similarity_of(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) >= similarity
                for x, y in zip(of_a, of_b, strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(compare, "a long, b long")


def _across(names: np.ndarray, labels: np.ndarray, shares: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links between members of different labels, one for each two labels that they connect.

    With two shares, those within a share are left to other tasks.
    """
    sizes = np.array([len(s) for s in sets])
    _, label = np.unique(labels, return_inverse=True)
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(tokens, kind="stable")
    holders = np.repeat(np.arange(len(sets)), sizes)[order]
    ends = np.cumsum(np.bincount(tokens))
    mine = np.split(tokens, np.cumsum(sizes)[:-1])
    two = len(np.unique(shares)) > 1
    found = []
    for x in np.flatnonzero(label != np.bincount(label).argmax()):
        may = (label != label[x]) & (np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x]) - 1e-6)
        if two:
            may &= shares != shares[x]
        if not may.any():
            continue
        held = [holders[ends[t - 1] if t else 0 : ends[t]] for t in mine[x].tolist()]
        common = np.bincount(np.concatenate(held), minlength=len(sets))
        near = np.flatnonzero(may & (common / (sizes + sizes[x] - common) >= similarity))
        for y in near.tolist():
            if label[y] != label[x]:
                found.append((int(names[x]), int(names[y])))
                label[label == label[y]] = label[x]
    return found


def _apart(members: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float, crowd: int) -> DataFrame:
    """Links (a, b) between members (key, set) of one bucket that `labels` has in different components."""
    labelled = members.join(labels, members["set"] == labels["node"], "left").select(
        "key", "set", F.coalesce("label", "set").alias("label")
    )
    labelled = written(labelled, "near-labelled")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
    mixed = mixed.where("low <> high").select("key", F.ceil(F.col("n") / crowd).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("set"), F.col("shares")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("other")
    dealt = labelled.join(mixed, "key").withColumn("share", share).select("key", "set", "label", "share", other)
    dealt = dealt.select("key", F.least("share", "other").alias("i"), F.greatest("share", "other").alias("j"), "set", "label", "share")
    full = dealt.join(sets.select("set", "shingles"), "set").select("key", "i", "j", "set", "label", "share", "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of (key, i, j)."""
        rows = (
            row for batch in batches
            for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True)
        )
        for _, group in itertools.groupby(rows, key=lambda row: row[:3]):
            _, _, _, names, labels, shares, shingles = zip(*group, strict=True)
            if len(set(labels)) > 1:
                held = [np.frombuffer(s, dtype=np.uint64) for s in shingles]
                found = _across(np.array(names), np.array(labels), np.array(shares), held, similarity)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    gathered = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return gathered.mapInArrow(compare, "a long, b long").distinct()


def linked_components(
    distinct: DataFrame, more: DataFrame, sets_of, similarity: float, crowd: int = CROWD,
) -> DataFrame:
    """(node, label) for the sets that are linked, the label being a component's smallest set.

    `distinct` has a row (set, bands) for each set, `more` further candidates (a, b), and `sets_of` gives
    the rows (set, n, shingles) of a table of sets.
    """
    keys = distinct.select(F.explode("bands").alias("key"), "set")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("set").alias("low"), F.max("set").alias("high"))
    members = written(keys.join(sizes.where("n > 1"), "key").select("key", "set", "low", "high"), "near-members")
    ends = members.select(F.col("set").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    pairs = ends.unionByName(more.select("a", "b")).where("a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-pairs")
    needed = members.select("set").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("set"))).distinct()
    sets = written(sets_of(needed), "near-sets")
    links = written(_confirmed(pairs, sets, similarity), "near-links")
    rest = written(_apart(members.select("key", "set"), components(links), sets, similarity, crowd), "near-rest")
    return components(links.unionByName(rest))
