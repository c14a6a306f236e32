"""Removal of repeated word sequences by recompression.

Words are symbols with global names. A level replaces runs of one symbol by a symbol for (symbol, run
length), and then every pair whose left symbol is of the left half of the alphabet and whose right one
is of the right half by a symbol for the pair; which half a symbol is in follows from its name. Names
are 64-bit fingerprints of what they stand for, so equal sequences get equal interior symbols in all
documents, and only symbols near the two ends of a sequence depend on what surrounds it. For each
symbol the span of words that its making looked at is kept.

Spark rounds, one for the words and one per level, count the symbols globally. A symbol that occurs
once shows that no window around its span repeats; so a round leaves alive only windows all of whose
interior symbols are shared, and the next round names symbols of living windows alone.

A living window is then known by the symbols of the last level that lie within it and by where they start:
equal windows have the same ones, wherever they stand. Windows that agree in these are repeats if their
words do, which is verified by a second name, of the words that the symbols expand to and those beside them.
A window that holds no symbol of the last level whole is known by its words. The earliest of equal windows
stays. A round leaves out windows alone that cannot repeat, so the result is that of comparing all windows.

Defined results
* A null or empty text has no words and nothing is removed. A text shorter than the window is kept.
* Texts are ordered by id, null ids first; rows that share an id by their place in the input.
* An empty table gives an empty result. Only the id and the text are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from prefspark.llm.blocks import (
    NO_ID, NOTE, Block, answers_by_step, ask, attach, joined_names, make_blocks, mixed, note, pack_sorted, part_bounds,
    partitions_for, questions, unpack_sorted,
)

WINDOW = 20
LEVELS = 2
RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"
_FAR = 1 << 40
_ALL = (1 << 64) - 1
#: An odd number and its inverse modulo 2 ** 64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Symbols:
    """The symbols of a block at one level: name, document, the span of words each depends on, and the word
    that each starts with."""

    def __init__(self, name, document, low, high, start):
        self.name, self.document, self.low, self.high, self.start = name, document, low, high, start

    @classmethod
    def words(cls, block: Block) -> Symbols:
        place = np.arange(len(block.tokens), dtype=np.int64)
        return cls(block.names, block.document, place, place + 1, place)

    def _beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the left and the right neighbour's spans end; far away at the ends of a document."""
        low, high = np.full(len(self.name), -_FAR), np.full(len(self.name), _FAR)
        same = self.document[1:] == self.document[:-1]
        low[1:][same] = self.low[:-1][same]
        high[:-1][same] = self.high[1:][same]
        return low, high

    def runs(self, level: int) -> Symbols:
        n = len(self.name)
        first = np.ones(n, dtype=bool)
        first[1:] = (self.name[1:] != self.name[:-1]) | (self.document[1:] != self.document[:-1])
        at = np.flatnonzero(first)
        length = np.diff(at, append=n)
        last = at + length - 1
        name = self.name[at]
        run = length > 1
        name[run] = joined_names(name[run], length[run].astype(np.uint64), 4 * level)
        low, high = self._beside()
        return Symbols(name, self.document[at], low[at], high[last], self.start[at])

    def pairs(self, level: int) -> Symbols:
        n = len(self.name)
        left = (mixed(self.name, 4 * level + 2) & np.uint64(1)) == 0
        opens = np.zeros(n, dtype=bool)
        opens[:-1] = left[:-1] & ~left[1:] & (self.document[1:] == self.document[:-1])
        kept = np.ones(n, dtype=bool)
        kept[1:] = ~opens[:-1]
        before, after = self._beside()
        # A pair depends on its two symbols; a single one also on the neighbour it could have met.
        low, high = np.where(left, self.low, before), np.where(left, after, self.high)
        name = self.name.copy()
        at = np.flatnonzero(opens)
        low[at], high[at] = self.low[at], self.high[at + 1]
        name[at] = joined_names(self.name[at], self.name[at + 1], 4 * level + 3)
        return Symbols(name[kept], self.document[kept], low[kept], high[kept], self.start[kept])

    def next_level(self, level: int) -> Symbols:
        return self.runs(level).pairs(level)


class Windows:
    """Which windows of a block may still repeat; step by step as the answers come."""

    def __init__(self, block: Block, replies: dict[int, list[bytes]], done: int, parts: int, window: int, levels: int):
        """`done`: the rounds that are over; a round in which the block asked nothing has no replies."""
        self.block, self.window, self.parts = block, window, parts
        n = len(block.tokens)
        begun, self.alive = 0, np.zeros(n, dtype=bool)
        if NOTE in replies:
            note_of = replies[NOTE][0]
            begun, self.alive = note_of[0], np.unpackbits(np.frombuffer(note_of, dtype=np.uint8, offset=1), count=n).astype(bool)
        elif n >= window:
            starts = np.arange(n - window + 1)
            self.alive[: n - window + 1] = block.document[starts] == block.document[starts + window - 1]
        self.symbols = Symbols.words(block)
        for step in range(done):
            if step >= begun:
                self.cull(replies.get(step, []))
            if step < levels:
                self.symbols = self.symbols.next_level(step + 1)

    def note(self, done: int) -> tuple:
        """The living windows after `done` rounds, for the next question."""
        return note(self.block.number, bytes([done]) + np.packbits(self.alive).tobytes())

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that lie within a living window: their places, and the range of its starts."""
        s, n = self.symbols, len(self.alive)
        fits = np.flatnonzero(s.high - s.low <= self.window)
        living = np.concatenate(([0], np.cumsum(self.alive)))
        lows, highs = np.maximum(s.high[fits] - self.window, 0), np.minimum(s.low[fits] + 1, n)
        return fits[living[highs] > living[lows]], living

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names of these symbols, sorted, and whether this block has the name twice."""
        names, counts = np.unique(self.symbols.name[self.asked()[0]], return_counts=True)
        return names, counts > 1

    def cull(self, bits: list[bytes]) -> None:
        """Ends the windows around symbols that occur once."""
        at, _ = self.asked()
        names, place = np.unique(self.symbols.name[at], return_inverse=True)
        shared = joined_bits(bits, part_bounds(names, self.parts))
        single = at[~shared[place]]
        n = len(self.alive)
        low = np.maximum(self.symbols.high[single] - self.window, 0)
        high = np.minimum(self.symbols.low[single] + 1, n)
        depth = np.bincount(low, minlength=n + 1) - np.bincount(high, minlength=n + 1)
        self.alive &= np.cumsum(depth)[:n] == 0

    def symbol_names(self, starts: np.ndarray) -> np.ndarray:
        """A name of each window from the symbols within it and their places in it."""
        by_words = window_names(self.block.names, starts, self.window, 0x9E6C63D0676A9A99)
        s = self.symbols
        fits = np.flatnonzero(s.high - s.low <= self.window)
        if not len(fits) or not len(starts):
            return by_words
        # Spans of these grow along the block, so those within a window follow each other.
        first, end = np.searchsorted(s.low[fits], starts), np.searchsorted(s.high[fits], starts + self.window, side="right")
        power = np.cumprod(np.full(len(self.alive) + 1, _BASE), dtype=np.uint64)
        back = np.cumprod(np.full(len(self.alive) + 1, _BASE_BACK), dtype=np.uint64)
        placed = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(s.name[fits], 91) * power[s.start[fits]], dtype=np.uint64)))
        # As a polynomial whose powers are places within the window.
        inside = (placed[np.maximum(end, first)] - placed[first]) * back[starts]
        return np.where(end > first, mixed(inside, 93), by_words)

    def candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Living windows: their starts, two names each, and the first of those with equal names.

        In the order of the names; of equal names the first is the earliest text and place.
        """
        starts = np.flatnonzero(self.alive)
        one = self.symbol_names(starts)
        two = window_names(self.block.names, starts, self.window, 0xB5026F5AA96619E9)
        owner = self.block.ids[self.block.document[starts]]
        order = np.argsort(one, kind="stable")
        same = one[order][1:] == one[order][:-1]
        apart = two[order][1:] != two[order][:-1]
        if (same & (apart | (owner[order][1:] < owner[order][:-1]))).any():
            # Texts out of the order of their ids, or two names of which only the first is equal.
            order = np.lexsort((starts, owner, two, one))
            same, apart = one[order][1:] == one[order][:-1], two[order][1:] != two[order][:-1]
        first = np.ones(len(starts), dtype=bool)
        first[1:] = ~same | apart
        return starts[order], one[order], two[order], first


def window_names(names: np.ndarray, starts: np.ndarray, window: int, base: int) -> np.ndarray:
    """A polynomial over the names of each window's words, built by doubling, then mixed."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    piece, length, power = mixed(names, base & 0xFFFF), 1, base
    total, done, scale = np.zeros(len(names), dtype=np.uint64), 0, 1
    while True:
        if window & length:
            moved = np.zeros(len(names), dtype=np.uint64)
            moved[: len(names) - done] = piece[done:]
            total, scale, done = total + moved * np.uint64(scale), scale * power & _ALL, done + length
        if done == window:
            return mixed(total[starts], 77)
        moved = np.zeros(len(names), dtype=np.uint64)
        moved[: max(len(names) - length, 0)] = piece[length:]
        piece, length, power = piece + moved * np.uint64(power), 2 * length, power * power & _ALL


def joined_bits(payloads: list[bytes], bounds: np.ndarray) -> np.ndarray:
    sizes = np.diff(bounds)
    sizes = sizes[sizes > 0]
    bits = [np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=int(n)) for p, n in zip(payloads, sizes, strict=True)]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, dtype=bool)


def _shared(blocks: np.ndarray, payloads: list[bytes]) -> Iterator[tuple[int, bytes, None]]:
    """For each block and symbol: whether it occurs more than once in all blocks."""
    # Eight bytes a name, then a bit a name, filled up to a whole byte.
    keys = [unpack_sorted(p[: len(p) * 8 // 65 * 8]) for p in payloads]
    twice = [np.unpackbits(np.frombuffer(p[8 * len(k) :], dtype=np.uint8), count=len(k)) for p, k in zip(payloads, keys, strict=True)]
    _, place, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    weight = count + np.bincount(place, weights=np.concatenate(twice), minlength=len(count))
    shared, at = weight[place] > 1, 0
    for block, own in zip(blocks, keys, strict=True):
        yield block, np.packbits(shared[at : at + len(own)]).tobytes(), None
        at += len(own)


def _later(blocks: np.ndarray, payloads: list[bytes]) -> Iterator[tuple[int, bytes, None]]:
    """For each block and window: whether an equal window starts earlier in another place."""
    counts = [len(p) // 28 for p in payloads]
    column = lambda a, b, kind: np.concatenate(
        [np.frombuffer(p[a * n : b * n], dtype=kind) for p, n in zip(payloads, counts, strict=True)]
    )
    one = np.concatenate([unpack_sorted(p[: 8 * n]) for p, n in zip(payloads, counts, strict=True)])
    two, owner, start = column(8, 16, np.uint64), column(16, 24, np.int64), column(24, 28, np.uint32)
    order = np.lexsort((start, np.repeat(blocks, counts), owner, two, one))
    later = np.zeros(len(one), dtype=bool)
    a, b = order[:-1], order[1:]
    later[b] = (one[a] == one[b]) & (two[a] == two[b])
    for block, bits in zip(blocks, np.split(later, np.cumsum(counts)[:-1]), strict=True):
        yield block, np.packbits(bits).tobytes(), None


def dedup_substrings(docs: DataFrame, *, window=WINDOW, levels=LEVELS, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: words, removed words, the text of the kept words, and the removed spans.

    A word is removed if a window of `window` consecutive words that covers it also starts earlier: in a
    text with a smaller id, or earlier in the same one. Windows are those of the input.
    """
    blocks = make_blocks(docs, id_col=id_col, text_col=text_col)
    parts = partitions_for(blocks)

    def names_of(step: int):
        def question(block: Block, replies, parts: int) -> list[tuple]:
            windows = Windows(block, replies, step, parts, window, levels)
            names, twice = windows.keys()
            pack = lambda s: pack_sorted(names[s]) + np.packbits(twice[s]).tobytes()
            return [*questions(block.number, names, parts, pack), windows.note(step)]

        return question

    def windows_of(block: Block, replies, parts: int) -> list[tuple]:
        windows = Windows(block, replies, levels + 1, parts, window, levels)
        starts, one, two, first = windows.candidates()
        starts, one, two = starts[first].astype(np.uint32), one[first], two[first]
        owner = block.ids[block.document[starts]]

        def pack(s: slice) -> bytes:
            return pack_sorted(one[s]) + two[s].tobytes() + owner[s].tobytes() + starts[s].tobytes()

        return [*questions(block.number, one, parts, pack), windows.note(levels + 1)]

    answers = None
    for step in range(levels + 2):
        question, reply = (names_of(step), _shared) if step <= levels else (windows_of, _later)
        told = ask(blocks, answers, step, parts, question, reply, f"substrings-{step}")
        answers = told if answers is None else answers.unionByName(told)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield _removed(Block(row), answers_by_step(row), parts, window, levels)

    return attach(blocks, answers).mapInPandas(finish, RESULT)


def _removed(block: Block, replies: dict[int, list[bytes]], parts: int, window: int, levels: int) -> pd.DataFrame:
    last = replies.pop(levels + 1, [])
    starts, one, _, first = Windows(block, replies, levels + 1, parts, window, levels).candidates()
    later = ~first
    later[first] = joined_bits(last, part_bounds(one[first], parts))
    n = len(block.tokens)
    found = starts[later]
    depth = np.bincount(found, minlength=n + 1) - np.bincount(found + window, minlength=n + 1)
    gone = np.cumsum(depth)[:n] > 0
    counts = np.bincount(block.document[gone], minlength=len(block.ids))
    kept_words = list(map(block.vocabulary.__getitem__, block.tokens[~gone].tolist()))
    kept_ends = np.cumsum(block.lengths - counts)
    texts, spans, begin, at = [], [], 0, 0
    for end, kept_end, count in zip(block.ends.tolist(), kept_ends.tolist(), counts.tolist(), strict=True):
        texts.append(b" ".join(kept_words[at:kept_end]).decode("utf-8", "surrogatepass"))
        edges = np.flatnonzero(np.diff(gone[begin:end], prepend=False, append=False)).tolist() if count else []
        spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        begin, at = end, kept_end
    ids = pd.array([None if i == NO_ID else i for i in block.ids.tolist()], dtype="Int64")
    return pd.DataFrame({"doc_id": ids, "n_words": block.lengths, "n_removed": counts, "kept_text": texts, "removed": spans})
