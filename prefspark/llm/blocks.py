"""Blocks of documents, and questions that blocks ask of key partitions.

Some operators need facts about very many keys (word runs, n-grams), each of which many documents hold.
Here a block is one row with the words of about a million tokens as numbers. For each question a block
sends its distinct keys, sorted and packed, one row per key partition; a partition compares what all
blocks sent and gives each of them one packed row of answers, in the order of its keys. So what is
shuffled is bytes per distinct key and block, no key is hot (a block names it once), and a partition
holds a bounded number of keys as the number of partitions follows the number of words.

Defined results
* A null or empty text is a document without words; a null id is NO_ID, and comes first.
* Repeated rows and ids are documents of their own. An empty table gives no blocks, no questions and no answers.
* Only the id, the text and the flag are read; other columns do not matter, whatever their names.

Blocks and answers are written tables. A block's questions follow from its row and its earlier answers
alone, so a task that is run again asks the same.
"""

from __future__ import annotations

import array
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import written

BLOCK_WORDS = 1 << 20
#: Keys that one partition compares at a time, on average.
PARTITION_KEYS = 2 << 20
BLOCK = "block long, ids binary, flags binary, lengths binary, tokens binary, vocabulary binary, words long"
QUESTION = "part int, block long, payload binary"
ANSWER = "block long, step int, part int, payload binary, stats array<double>"
#: Stands for a null id, and comes first.
NO_ID = -(2**63)
NOTE = -1
#: The block of rows that are tables of keys.
MODEL = -1


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, byte plane by byte plane, so that the codec of the shuffle
    and of the tables finds the high planes to be zeros."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_small(numbers: np.ndarray) -> bytes:
    """32-bit numbers, most of them small, byte plane by byte plane for the same reason."""
    return numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_small(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer over unsigned numbers."""
    x = keys + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined_names(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """A name for each pair: equal pairs get equal names wherever they stand."""
    return mixed(mixed(a, salt) + b * np.uint64(0xD6E8FEB86659FD93), salt + 1)


class Block:
    """One row of the table of blocks."""

    def __init__(self, row):
        self.number = int(row.block)
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.flags = np.frombuffer(row.flags, dtype=np.uint8).astype(bool)
        self.lengths = np.frombuffer(row.lengths, dtype=np.uint32).astype(np.int64)
        self.tokens = unpack_small(row.tokens)
        self.raw_vocabulary = row.vocabulary
        self.ends = np.cumsum(self.lengths)

    @functools.cached_property
    def vocabulary(self) -> list[bytes]:
        return self.raw_vocabulary.split(b" ") if self.raw_vocabulary else []

    @functools.cached_property
    def vocabulary_names(self) -> np.ndarray:
        digests = map(xxhash.xxh3_64_intdigest, self.vocabulary)
        return np.fromiter(digests, dtype=np.uint64, count=len(self.vocabulary))

    @functools.cached_property
    def names(self) -> np.ndarray:
        return self.vocabulary_names[self.tokens]

    @functools.cached_property
    def document(self) -> np.ndarray:
        """The document (its place in the block) of each token."""
        return np.repeat(np.arange(len(self.ids), dtype=np.int64), self.lengths)


def make_blocks(
    docs: DataFrame, *, lower=False, flag: Column | None = None, block_words=BLOCK_WORDS,
    id_col="doc_id", text_col="text",
) -> DataFrame:
    """The written table of blocks. A document is never divided; one above the size is its own block."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, done = TaskContext.get().partitionId() << 32, 0
        ids, flags, lengths, tokens, number = [], [], [], array.array("I"), {}

        def row() -> pd.DataFrame:
            packed = (
                base + done, np.array(ids, dtype=np.int64).tobytes(), np.array(flags, dtype=np.uint8).tobytes(),
                np.array(lengths, dtype=np.uint32).tobytes(), pack_small(np.frombuffer(tokens, dtype=np.uint32)),
                b" ".join(number), len(tokens),
            )
            return pd.DataFrame([packed], columns=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for record_id, text, marked in zip(batch["id"], batch["text"], batch["flag"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                words = (raw.lower() if lower else raw).split()
                if ids and len(tokens) + len(words) > block_words:
                    yield row()
                    done += 1
                    ids, flags, lengths, tokens, number = [], [], [], array.array("I"), {}
                ids.append(NO_ID if record_id is None else int(record_id))
                flags.append(bool(marked))
                lengths.append(len(words))
                tokens.extend([number.setdefault(w, len(number)) for w in words])
        if ids:
            yield row()

    rows = docs.select(
        F.col(id_col).cast("long").cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        (F.lit(False) if flag is None else flag).alias("flag"),
    )
    return written(rows.mapInPandas(build, BLOCK), "blocks")


def partitions_for(blocks: DataFrame) -> int:
    """Key partitions: one for each PARTITION_KEYS words."""
    return int((blocks.agg(F.sum("words")).first()[0] or 0) // PARTITION_KEYS) + 1


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The partition of each key; equal ranges of keys, in order. `parts` is below 2 ** 32."""
    return (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def part_bounds(sorted_keys: np.ndarray, parts: int) -> np.ndarray:
    """Where in the sorted keys each partition that has some begins, and the end."""
    part = parts_of(sorted_keys, parts)
    edges = np.flatnonzero(part[1:] != part[:-1]) + 1
    return np.concatenate(([0], edges, [len(part)])) if len(part) else np.zeros(1, dtype=np.int64)


def questions(number: int, keys: np.ndarray, parts: int, pack: Callable[[slice], bytes]) -> list[tuple]:
    bounds = part_bounds(keys, parts).tolist()
    named = parts_of(keys[bounds[:-1]], parts).tolist()
    return [(part, number, pack(slice(a, b))) for part, a, b in zip(named, bounds, bounds[1:])]


def attach(blocks: DataFrame, answers: DataFrame | None) -> DataFrame:
    """The blocks with all answers they got so far, which are smaller than the blocks themselves."""
    if answers is None:
        return blocks.withColumn("answers", F.lit(None).cast("array<struct<step:int,part:int,payload:binary>>"))
    # Rows of no block (numbers to sum up, tables of keys) are not for the blocks.
    own = answers.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("step", "part", "payload")).alias("answers"))
    return blocks.join(own, "block", "left")


def answers_by_step(row) -> dict[int, list[bytes]]:
    """Of one row: for each step the payloads in the order of the partitions; under NOTE the last note."""
    found: dict[int, list[tuple[int, bytes]]] = {}
    last = -1
    for answer in [] if row.answers is None else row.answers:
        if answer["part"] >= 0:
            found.setdefault(answer["step"], []).append((answer["part"], answer["payload"]))
        elif answer["step"] > last:
            last, found[NOTE] = answer["step"], [(0, answer["payload"])]
    return {step: [payload for _, payload in sorted(parts)] for step, parts in found.items()}


def note(number: int, payload: bytes) -> tuple:
    """A row that a block sends to itself, so that its next question need not start from the beginning."""
    return -1 - number % 1_000_003, number, payload


def ask(blocks: DataFrame, answers: DataFrame | None, step: int, parts: int, question, reply, label: str) -> DataFrame:
    """One exchange: the answers of this step as a written table.

    `question(block, replies, parts)` gives rows of QUESTION; `reply(blocks, payloads)` gives, for the rows of
    one partition in ascending order of blocks, rows of (block, payload, numbers to sum up or None).
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                rows = question(Block(row), answers_by_step(row), parts)
                yield pd.DataFrame(rows, columns=["part", "block", "payload"])

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        part = int(group["part"].iloc[0])
        if part < 0:
            return group.assign(step=step, stats=None)[["block", "step", "part", "payload", "stats"]]
        rows = reply(group["block"].to_numpy(), list(group["payload"]))
        told = [(b, step, part, payload, numbers) for b, payload, numbers in rows]
        return pd.DataFrame(told, columns=["block", "step", "part", "payload", "stats"])

    asked = attach(blocks, answers).mapInPandas(send, QUESTION)
    return written(asked.groupBy("part").applyInPandas(compare, ANSWER), label)


def look_up(blocks: DataFrame, tables: DataFrame, step: int, parts: int, question, reply, label: str) -> DataFrame:
    """Answers from stored tables (rows with block = MODEL): as `ask`, with `reply(keys, payload)` giving what a
    partition's table, None if there is none, says of the keys that a block sent.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame(question(Block(row), {}, parts), columns=["part", "block", "payload"])

    def answer(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        table = stored["payload"].iloc[0] if len(stored) else None
        told = [(r.block, step, r.part, reply(unpack_sorted(r.payload), table), None) for r in asked.itertuples(index=False)]
        return pd.DataFrame(told, columns=["block", "step", "part", "payload", "stats"])

    stored = tables.where((F.col("block") == MODEL) & (F.col("step") == step)).select("part", "payload")
    # A partition's table meets all questions at once, and not each of them.
    met = blocks.mapInPandas(send, QUESTION).groupBy("part").cogroup(stored.groupBy("part"))
    return written(met.applyInPandas(answer, ANSWER), label)


def summed(answers: DataFrame) -> list[float]:
    """The numbers that the partitions told, added up by place."""
    each = answers.where("stats is not null").select(F.posexplode("stats").alias("place", "number"))
    return [r[1] for r in each.groupBy("place").agg(F.sum("number")).orderBy("place").collect()]
