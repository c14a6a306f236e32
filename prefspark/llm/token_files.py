"""Token ids in files of length-delimited binary records, with an offset index beside each file.

A token file holds one record per document, in ascending order of id, and a small index file holds for
each record its id, its byte offset and its number of tokens, so that readers may fetch records in any
order. All numbers are little-endian.

    file    magic "TOKREC01", then records
    record  length of data (u64), masked checksum of those 8 bytes (u32), data, masked checksum of data (u32)
    data    bytes per token id (u8: 2 or 4), then the ids
    index   magic "TOKIDX01", then per record: has id (u8), id (i64), offset (u64), tokens (u64)

A masked checksum is the crc32, rotated right by 15 bits, plus 0xa282ead8, so that a checksum over data
that contains checksums stays meaningful.

Files are written by the tasks into the shared folder under names that no other attempt has; the table
of files that Spark commits names those that count, so a task that is run again leaves nothing wrong.

Defined results
* A null text is an empty one: its record holds the end id alone.
* Rows with equal ids keep one record each, next to each other; null ids come first.
* An empty table gives no files. Output depends on no further columns.
"""

from __future__ import annotations

import array
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import process_cache, written
from prefspark.session import new_workdir

MAGIC, INDEX_MAGIC = b"TOKREC01", b"TOKIDX01"
END_ID = 2
#: Pieces in each of the two generations that a worker process remembers.
MEMO_ENTRIES = 350_000
#: Characters of text in pieces at a time.
ENCODE_CHARS = 1 << 20
PARTITION_BYTES = 16 << 20

def masked(checksum: int) -> int:
    return (((checksum >> 15) | (checksum << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """Ids of whole texts, as bytes, equal to those of the tokenizer on the whole text.

    A byte-level tokenizer cuts texts before it merges, and never across the place where a blank
    follows another character. So the ids of a text are those of its pieces between such places, and
    pieces that come again need not be encoded again. New pieces are encoded many at a time, as one text;
    as every id stands for known bytes, their ids are told apart by length. Texts with unusual blanks are
    encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # The vocabulary writes each byte as one character.
        self.lengths = np.zeros(size, dtype=np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.lengths[number] = added.get(number, len(token))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array(self.code, e.ids).tobytes() for e in done]

    def _learn(self, pieces: list[str]) -> None:
        """Adds the ids of pieces to the memo. A piece is without the space before it; a first piece of a
        text, which has none, has a zero there. In front of that one a line feed is encoded and left out."""
        for k in range(0, len(pieces), 20_000):
            part = pieces[k : k + 20_000]
            shown = ["\n" + p[1:] if p[0] == "\0" else p if p[0] == "\n" else " " + p for p in part]
            ids = np.frombuffer(self._encode(["".join(shown)])[0], dtype=f"<u{self.width}")
            ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in shown])
            reached = np.cumsum(self.lengths[ids])
            last = np.searchsorted(reached, ends)
            if len(ids) and not np.array_equal(reached[np.minimum(last, len(ids) - 1)], ends):
                self.memo.update(zip(part, self._encode(["" + (p[1:] if p[0] == "\0" else s) for p, s in zip(part, shown, strict=True)]), strict=True))
                continue
            raw, begin = ids.tobytes(), 0
            for piece, end in zip(part, ((last + 1) * self.width).tolist(), strict=True):
                self.memo[piece] = raw[begin + self.width if piece[0] == "\0" else begin : end]
                begin = end

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.older = {}, self.memo
        out: list[bytes | None] = [None] * len(texts)
        pieces = {k: ("\0" + t).replace("\n", " \n").split(" ") for k, t in enumerate(texts)}
        # No blank follows another, and none is but a space or a line feed: only then does a token start at
        # every one of them, whatever surrounds it.
        whole = [k for k, t in enumerate(texts) if " ".join(t.split()) != t.replace("\n", " ") or "\0" in t or not t]
        for k, ids in zip(whole, self._encode([texts[k] for k in whole]), strict=True):
            out[k] = ids
            del pieces[k]
        memo, older = self.memo, self.older
        missing = set().union(*pieces.values()).difference(memo)
        for p in missing & older.keys():
            memo[p] = older[p]
        self._learn([p for p in missing if p not in memo])
        for k, parts in pieces.items():
            out[k] = b"".join(map(memo.__getitem__, parts))
        return out


def _portions(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about ENCODE_CHARS characters, or one longer text."""
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > ENCODE_CHARS:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(text) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def _write_file(folder: str, records: Iterator[tuple[int | None, bytes, int]]) -> list[tuple]:
    """Writes one token file and its index; a row (file, records, tokens, first id), or none."""
    first = next(records, None)
    if first is None:
        return []
    system, root = fs.FileSystem.from_uri(folder)
    name = uuid.uuid4().hex
    offset, n, tokens = len(MAGIC), 0, 0
    with system.open_output_stream(f"{root}/{name}.tok") as data, system.open_output_stream(f"{root}/{name}.idx") as index:
        data.write(MAGIC)
        index.write(INDEX_MAGIC)
        record = first
        while record is not None:
            record_id, ids, width = record
            body = bytes([width]) + ids
            length = struct.pack("<Q", len(body))
            frame = length + struct.pack("<I", masked(zlib.crc32(length))) + body + struct.pack("<I", masked(zlib.crc32(body)))
            data.write(frame)
            index.write(struct.pack("<BqQQ", record_id is not None, record_id or 0, offset, len(ids) // width))
            offset, n, tokens = offset + len(frame), n + 1, tokens + len(ids) // width
            record = next(records, None)
    return [(name, n, tokens, offset)]


def write_token_files(
    docs: DataFrame, tokenizer_path: str, *, folder: str | None = None, end_id: int | None = END_ID,
    files: int | None = None, id_col="doc_id", text_col="text",
) -> tuple[str, DataFrame]:
    """Writes the texts' ids; returns the folder and its table of files in ascending order of ids.

    The table: position, file, records, tokens, bytes, first_token (tokens in the files before it). It
    has one row per file. `files` defaults to one for each PARTITION_BYTES of text.
    """
    spark = docs.sparkSession
    folder = folder or new_workdir(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if files is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = int(size // PARTITION_BYTES) + 1
    # Rows that share an id, or have none, are spread by their texts.
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    sorted_rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    # Ids travel as text: a column of numbers with nulls would reach pandas as floats.
    sorted_rows = sorted_rows.select(F.col("id").cast("string").alias("id"), "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder = process_cache(f"encoder {tokenizer_path}", lambda: Encoder(tokenizer_path))
        end = b"" if end_id is None else array.array(encoder.code, [end_id]).tobytes()

        def records():
            for batch in batches:
                ids, texts = list(batch["id"]), list(batch["text"])
                for part in _portions(texts):
                    for record_id, data in zip(ids[part], encoder.encode(texts[part]), strict=True):
                        yield None if record_id is None else int(record_id), data + end, encoder.width

        made = _write_file(folder, records())
        place = TaskContext.get().partitionId()
        yield pd.DataFrame([(place, *row) for row in made], columns=["place", "file", "records", "tokens", "bytes"])

    made = sorted_rows.mapInPandas(write, "place int, file string, records long, tokens long, bytes long")
    made = written(made, "token-file-list")
    order = Window.orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    listing = made.select(
        (F.row_number().over(order) - 1).alias("position"), "file", "records", "tokens", "bytes",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first_token"),
    )
    return folder, listing


def read_index(raw: bytes) -> np.ndarray:
    if raw[:8] != INDEX_MAGIC:
        raise ValueError("not an index of a token file")
    kind = np.dtype([("has_id", "u1"), ("id", "<i8"), ("offset", "<u8"), ("tokens", "<u8")])
    return np.frombuffer(raw, dtype=kind, offset=8)


def read_record(raw: memoryview, offset: int) -> np.ndarray:
    """The ids of the record at an offset, after both checksums have been compared."""
    head = bytes(raw[offset : offset + 8])
    (length,), (check,) = struct.unpack("<Q", head), struct.unpack("<I", raw[offset + 8 : offset + 12])
    if masked(zlib.crc32(head)) != check:
        raise ValueError(f"damaged length at byte {offset}")
    body = raw[offset + 12 : offset + 12 + length]
    if len(body) != length or masked(zlib.crc32(body)) != struct.unpack("<I", raw[offset + 12 + length : offset + 16 + length])[0]:
        raise ValueError(f"damaged record at byte {offset}")
    return np.frombuffer(body, dtype="<u2" if body[0] == 2 else "<u4", offset=1)


def read_token_files(folder: str, listing: DataFrame, *, with_ids=True) -> DataFrame:
    """One row per record: id, start (tokens of all records before it), n_tokens, ids_crc32 and, unless
    told otherwise, `ids`. The checksum is over the ids as 32-bit numbers."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.itertuples():
                with system.open_input_stream(f"{root}/{row.file}.idx") as f:
                    index = read_index(f.read())
                with system.open_input_stream(f"{root}/{row.file}.tok") as f:
                    raw = memoryview(f.read())
                if raw[:8] != MAGIC or len(index) != row.records:
                    raise ValueError(f"{row.file} is not a whole token file")
                starts = row.first_token + np.cumsum(index["tokens"]) - index["tokens"]
                for at in range(0, len(index), 1000):
                    part = index[at : at + 1000]
                    ids = [read_record(raw, int(offset)) for offset in part["offset"]]
                    out = {
                        "id": pd.array([int(i) if has else None for has, i in zip(part["has_id"], part["id"], strict=True)], dtype="Int64"),
                        "start": starts[at : at + 1000].astype(np.int64),
                        "n_tokens": part["tokens"].astype(np.int64),
                        "ids_crc32": np.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], dtype=np.int64),
                    }
                    yield pd.DataFrame(out | ({"ids": [i.astype(np.int32) for i in ids]} if with_ids else {}))

    schema = "id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    # One file a task: the listing is one row per file, the files are the data.
    spread = listing.repartition(max(1, min(listing.count(), 100_000)), "position")
    return spread.mapInPandas(read, schema)
