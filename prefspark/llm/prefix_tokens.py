"""Token counts of every prefix of a text, stored, so that questions of length need no tokenizer.

The tokenizer is a byte-level BPE of the tokenizers library. It cuts a text into pieces and merges within
each. A piece's tokens have this property: the tokens of a prefix of the piece are those of a shorter
prefix and one more. So the counts follow by dynamic programming over the piece's bytes: the last token of
each prefix is the only one that ends there, and that stays next to the last token of the prefix before it
(the library merges the two together otherwise, which is asked once per pair and remembered). The count is
that of the prefix before it plus one.

Cutting a text also changes its pieces, at the cut alone: blanks at the end are one piece, whereas the last
of several blanks belongs to the word after it, and what follows an apostrophe is a piece of its own until
it is complete. Both are part of the counts. A special token's text counts as one token once it is
complete, as it does by the library's default.

A text is a row of runs of blanks with the word after each. Counts within such a chunk depend on the chunk
alone, so its steps (how much each further character adds, which may be negative) are remembered, and
those of a text are the steps of its chunks, one after another. They are stored as one signed byte per
character, or four where one is not enough.

Defined results
* A null text counts as an empty one: no bytes, no tokens, no steps.
* A prefix is counted in characters (code points). One past the end, or a negative one, counts as the
  nearest that exists; a null one has no count.
* Counts may fall as a text grows. `longest_within` gives the longest prefix within the limit, so all longer
  ones, the whole text included, are above it. A negative limit, which no prefix meets, gives null.
* Rows are judged one by one: repeated ids and rows are kept, all columns of the input too (`doc`), whatever
  their names. An empty table gives an empty table.
"""

from __future__ import annotations

import array
import contextlib
import json
import operator
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import process_cache, written

#: The characters that the tokenizer's pattern takes for blanks.
BLANK = r"\t-\r \x85\xa0  -     　"
PREFIXES = "n_bytes long, n_chars long, n_tokens long, width int, steps binary"
#: Chunks in each of the two generations that a worker process remembers, and pairs of tokens.
MEMO_CHUNKS, MEMO_PAIRS = 500_000, 1_000_000
#: Longer chunks are not remembered.
MEMO_CHARS = 64
#: Characters of text whose chunks are learned together.
PORTION = 4 << 20
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ʯ]+"
#: Chunks whose pieces are plain: a line feed, a word with or without its space, and marks after it.
_PLAIN = re.compile(rf"(?:(\n)({_LETTERS})|( ?{_LETTERS}))([.,;:!?]*)")
_BLANKS = re.compile(f"[{BLANK}]+")
_CHUNKS = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")


def byte_characters() -> str:
    """The character that stands for each byte: itself where it is printable, else the next one above 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


class PrefixCounter:
    """Counts of a tokenizer file. `steps(text)` is what each character adds to the number of tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cut, model = parts["pre_tokenizer"] or {}, parts["model"]
        bytewise = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        if parts["normalizer"] or not bytewise or model.get("type") != "BPE" or model.get("dropout"):
            raise ValueError(f"{path} is not a byte-level BPE without normalization")
        added = parts["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path} has added tokens that depend on what surrounds them")
        self.special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        #: For each token: of tokens before it, whether both stay as they are next to each other.
        self.stays: dict[str, dict[str, bool]] = {token: {} for token in model["vocab"]}
        self.pairs = 0
        self.table = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        # By the last three bytes: the lengths that a token with this end may have, longest first; and by the
        # last two where they are a token.
        lengths: dict[str, set[int]] = {}
        for token in self.stays:
            if len(token) > 1:
                lengths.setdefault(token[-3:], set()).add(len(token))
        for end, found in lengths.items():
            if end[1:] in lengths and len(end) == 3:
                found.add(2)
        self.lengths = {end: sorted(n, reverse=True) for end, n in lengths.items()}
        #: The piece counted last: its bytes, and for each prefix its last token and its count.
        self.previous: tuple[str, list[str], list[int]] = "", [""], [0]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ask(self, before: str, token: str) -> bool:
        """Whether the two tokens' bytes together have just these two tokens; the first may be empty."""
        found = [t.value for t in self.tokenizer.model.tokenize(before + token)]
        if self.pairs >= MEMO_PAIRS:
            for known in self.stays.values():
                known.clear()
            self.pairs = 0
        self.pairs += 1
        self.stays[token][before] = stays = found == ([before, token] if before else [token])
        return stays

    def _piece(self, piece: str) -> list[int]:
        """The count of each prefix of a piece, the empty one first, in characters."""
        plain = piece.isascii()
        raw = (piece if plain else piece.encode("utf-8", "surrogatepass").decode("latin-1")).translate(self.table)
        lengths, tokens = self.lengths.get, self.stays.get
        # The counts go on from what the piece has in common with the one before it.
        before, last, counts = self.previous
        same = 0
        for a, b in zip(before, raw):
            if a != b:
                break
            same += 1
        last, counts = (last[: same + 1], counts[: same + 1]) if same else (["", raw[:1]], [0, 1])
        for end in range(max(same, 1) + 1, len(raw) + 1):
            begin = end - 1
            for size in lengths(raw[end - 3 if end > 2 else 0 : end]) or lengths(raw[end - 2 : end], ()):
                if size <= end:
                    known = tokens(raw[end - size : end])
                    if known is not None:
                        stays = known.get(last[end - size])
                        if stays or (stays is None and self._ask(last[end - size], raw[end - size : end])):
                            begin = end - size
                            break
            last.append(raw[begin:end])
            counts.append(counts[begin] + 1)
        if len(raw) > 3:  # not for the marks between words
            self.previous = raw, last, counts
        if plain:
            return counts[: len(raw) + 1]
        ends, end = [0], 0
        for c in piece:
            end += len(c.encode("utf-8", "surrogatepass"))
            ends.append(end)
        return [counts[end] for end in ends]

    def _counts(self, chunk: str) -> list[int]:
        """The count of each prefix of a chunk, the empty one first."""
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            counts = [0]
            for piece in plain.groups():
                if piece:
                    total = counts[-1]
                    counts += [total + n for n in self._piece(piece)[1:]]
            return counts
        blanks = _BLANKS.match(chunk)
        run = blanks.end() if blanks else 0
        counts = self._piece(chunk[:run])
        if run == len(chunk):
            return counts
        total = 0
        for _, (low, high) in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk):
            piece = chunk[low:high]
            inside = self._piece(piece)
            if piece[0] == "'" and len(piece) == 3 and piece[1:].isalpha():
                inside[2] = len(self.tokenizer.encode(piece[:2], add_special_tokens=False).ids)
            if high > run:
                counts += [total + inside[k - low] for k in range(len(counts), high + 1)]
            total += inside[-1]
        return counts

    def _learn(self, key: str) -> bytes:
        """The steps of a chunk as signed bytes; an OverflowError where they do not fit.

        The key of a chunk that starts with a space and a word is without the space; a zero stands before one
        that starts with the word."""
        found = self.older.get(key)
        if found is None:
            chunk = key[1:] if key[0] == "\0" else key if _BLANKS.match(key) else " " + key
            counts = self._counts(chunk)
            found = array.array("b", map(operator.sub, counts[1:], counts)).tobytes()
        if len(key) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_CHUNKS:
                self.memo, self.older = {}, self.memo
            self.memo[key] = found
        return found

    @staticmethod
    def _keys(text: str) -> list[str]:
        """The text's chunks as the keys of `_learn`."""
        if text and "\0" not in text and " ".join(text.split()) == text.replace("\n", " "):
            # Single spaces and line feeds alone, and none at the ends.
            return ("\0" + text).replace("\n", " \n").split(" ")
        keys = []
        for chunk in _CHUNKS.findall(text):
            if chunk[0] == " " and len(chunk) > 1 and chunk[1] != "\0" and not _BLANKS.match(chunk, 1):
                keys.append(chunk[1:])
            else:
                keys.append(chunk if _BLANKS.match(chunk) else "\0" + chunk)
        return keys

    def _segment(self, text: str, keys: list[str] | None = None) -> np.ndarray:
        """Steps of a text without special tokens, as int8, or int32 where that is too small."""
        known, learn = self.memo.get, self._learn
        try:
            found = [known(k) or learn(k) for k in (self._keys(text) if keys is None else keys)]
            return np.frombuffer(b"".join(found), dtype=np.int8)
        except OverflowError:
            return np.concatenate([np.diff(self._counts(c)) for c in _CHUNKS.findall(text)]).astype(np.int32)

    def steps(self, text: str) -> np.ndarray:
        """What each character of the text adds to the number of tokens, as int8 or int32."""
        return self.steps_of([text])[0]

    def steps_of(self, texts: list[str]) -> list[np.ndarray]:
        """`steps` of each text. Their new chunks are learned in sorted order, so that a chunk is counted
        from where it parts from the one before it."""
        keys = [None if any(s in t for s in self.special) else self._keys(t) for t in texts]
        missing = set().union(*(k for k in keys if k is not None)).difference(self.memo, self.older)
        with contextlib.suppress(OverflowError):  # `_segment` meets it again
            for key in sorted(missing):
                self._learn(key)
        return [self._around_special(t) if k is None else self._segment(t, k) for t, k in zip(texts, keys, strict=True)]

    def _around_special(self, text: str) -> np.ndarray:
        found, begin = [], 0
        for match in self.special_pattern.finditer(text):
            before = text[begin : match.start()]
            found += [self._segment(before), self._special(before, match[0])]
            begin = match.end()
        steps = np.concatenate([*found, self._segment(text[begin:])])
        return steps.astype(np.int8 if steps.min() >= -128 and steps.max() <= 127 else np.int32)

    def _special(self, before: str, special: str) -> np.ndarray:
        """Steps of a special token's characters: until it is complete it is ordinary text."""
        chunks = _CHUNKS.findall(before)
        # What comes before is one chunk with it; if that is blanks alone, they are no longer at the end.
        joined = chunks[-1] if chunks else ""
        base = self._counts(joined)[-1]
        counts = [base]
        for n in range(1, len(special)):
            grown = _CHUNKS.findall(joined + special[:n])
            counts.append(sum(self._counts(c)[-1] for c in grown))
        return np.diff([*counts, base + 1])


def _portions(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about PORTION characters, or one longer text."""
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > PORTION:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(text) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def _counter(path: str) -> PrefixCounter:
    return process_cache(f"prefix counter {path}", lambda: PrefixCounter(path))


def prefixes(text: Column, tokenizer_path: str) -> Column:
    """A struct of PREFIXES for each text: its sizes and, packed, the count of each of its prefixes."""

    @F.pandas_udf(PREFIXES)
    def count(texts: pd.Series) -> pd.DataFrame:
        counter, rows, texts = _counter(tokenizer_path), [], list(texts)
        for part in _portions(texts):
            for t, steps in zip(texts[part], counter.steps_of(texts[part]), strict=True):
                n_bytes = len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass"))
                rows.append((n_bytes, len(t), int(steps.sum(dtype=np.int64)), steps.dtype.itemsize, steps.tobytes()))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PREFIXES.split(", ")])

    return count(F.coalesce(text, F.lit("")))


def _unpacked(width: int, steps: bytes) -> np.ndarray:
    """The counts of all prefixes, the empty one first."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, dtype=np.int8 if width == 1 else np.int32), dtype=np.int64)))


def tokens_before(stored: Column, place: Column) -> Column:
    """Tokens of the first `place` characters, from stored prefixes."""

    @F.pandas_udf("long")
    def read(width: pd.Series, steps: pd.Series, at: pd.Series) -> pd.Series:
        counts = (
            None if pd.isna(k) else int(_unpacked(w, s)[min(max(int(k), 0), len(s) // int(w))])
            for w, s, k in zip(width, steps, at, strict=True)
        )
        return pd.Series(list(counts), dtype="Int64")

    return read(stored["width"], stored["steps"], place.cast("long"))


def longest_within(stored: Column, limit: Column | int) -> Column:
    """Characters of the longest prefix of at most `limit` tokens, from stored prefixes."""

    @F.pandas_udf("long")
    def read(width: pd.Series, steps: pd.Series, most: pd.Series) -> pd.Series:
        found = []
        for w, s, m in zip(width, steps, most, strict=True):
            fits = np.array([], dtype=int) if pd.isna(m) else np.flatnonzero(_unpacked(w, s) <= m)
            found.append(int(fits[-1]) if len(fits) else None)
        return pd.Series(found, dtype="Int64")

    limit = F.lit(limit) if isinstance(limit, int) else limit
    # A text of no more bytes than the limit has no more tokens: a token is a byte at least.
    short = stored["n_bytes"] <= limit
    asked = F.when(~short, limit).cast("long")
    return F.when(short, stored["n_chars"]).otherwise(read(stored["width"], stored["steps"], asked))


def stored_prefixes(docs: DataFrame, tokenizer_path: str, *, keep: list[str] | None = None, text_col="text") -> DataFrame:
    """The written table of prefixes: `doc` (the columns `keep`, or all) and `prefix` (PREFIXES)."""
    columns = docs.columns if keep is None else keep
    return written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), prefixes(F.col(text_col), tokenizer_path).alias("prefix")
        ),
        "prefix-tokens",
    )


def truncated(stored: DataFrame, limit: int, *, text_col="text") -> DataFrame:
    """Of stored prefixes with their texts: the columns of `doc`, the text cut to its longest prefix of at
    most `limit` tokens. No text is encoded."""
    if limit < 0:
        raise ValueError(f"limit must not be negative, got {limit}")
    kept = F.substring(F.col(f"doc.{text_col}"), F.lit(1), longest_within(F.col("prefix"), limit).cast("int"))
    names = stored.schema["doc"].dataType.fieldNames()
    return stored.select(*[kept.alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in names])
