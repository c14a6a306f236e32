"""WARC archives of pages, and a capture index merged from sorted runs.

Every page becomes a record of its own gzip member. Of pages with equal payloads, of a given size at
least, the one with the largest id is written as a response and the others as revisits that name it.
Reading a file back gives its captures, checked against their digests and sorted by URL key,
timestamp and id: a run. The runs are merged into capture histories in global order: the key space is
cut into ranges, each run contributes one sorted piece to each range it reaches, and a loser tree
merges the pieces of a range. Ranges are cut by key, timestamp and id together, so that a URL that
holds a large part of all captures is cut too.

Defined results
* A null html is an empty payload; a null url has the empty key and no target header.
* A null page id counts as the smallest. Rows that repeat the id and payload of a response are
  responses as well, as nothing tells them apart.
* Without a timestamp column, a capture's time is the epoch plus its id in seconds.
* An empty table gives no files and no histories. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import written
from prefspark.session import new_workdir

READ_BYTES = 64 << 10
FILE_BYTES = 64 << 20
MIN_REVISIT_BYTES = 0
RANGE_CAPTURES = 100_000
_LEAST = -(2**63)
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = (
    "url_key string, time string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, file string, offset long, length long"
)
_COLUMNS = [part.split()[0] for part in CAPTURE.split(", ")]


def url_key(url: str | None) -> str:
    """The URL with its host reversed, so that pages of a site and its subdomains are neighbours."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:  # not a URL by its form: ordered by its text
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host.lower())
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    query = "?" + "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return f"{place}){parts.path.lower() or '/'}{query}"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url, time: str, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    mine = uuid.uuid4().hex if page_id is None else page_id
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_ID}{mine}>",
        f"WARC-Date: {time}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A header is one line; a URL with line ends or other blanks is kept by escaping them.
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_warc(
    pages: DataFrame, *, folder: str | None = None, min_revisit_bytes=MIN_REVISIT_BYTES, file_bytes=FILE_BYTES,
    id_col="page_id", url_col="url", html_col="html", time_col: str | None = None,
) -> tuple[str, DataFrame]:
    """Writes the archive; returns its folder and the table of its files (file, records, bytes).

    Payloads are compared by SHA-1 and length, in a grouping that sends one row per payload and task.
    Files get names that no other attempt has; the table that Spark commits says which ones count.
    """
    folder = folder or new_workdir(pages.sparkSession, "warc")
    epoch = F.timestamp_seconds(F.coalesce(F.col(id_col), F.lit(0)))
    time = F.date_format(F.col(time_col) if time_col else epoch, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    html = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), time.alias("time"),
        html.alias("payload"), F.unhex(F.sha1(html)).alias("sha"), F.octet_length(html).alias("size"),
    )
    first = rows.groupBy("sha", "size").agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("copies"))
    first = first.where((F.col("copies") > 1) & (F.col("size") >= min_revisit_bytes)).drop("copies")
    first = written(first, "warc-responses")
    # Ids travel as text: a column of numbers with nulls would reach pandas as floats.
    marked = rows.join(first, ["sha", "size"], "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "time", "payload",
        F.col("kept_id").cast("string").alias("kept_id"),
        (F.col("kept_id").isNotNull() & ~F.col("kept_id").eqNullSafe(F.col("page_id"))).alias("revisit"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                page_id, refers_to = (None if i is None else int(i) for i in (row.page_id, row.kept_id))
                member = warc_record(page_id, row.url, row.time, row.payload, refers_to, row.revisit)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pd.DataFrame(done, columns=["file", "records", "bytes"])

    return folder, written(marked.mapInPandas(write, "file string, records long, bytes long"), "warc-files")


def parse_member(raw: bytes) -> dict:
    """The capture of one unpacked record; raises if its payload does not have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        number = fields.get(name, "").strip("<>").removeprefix(_ID)
        return int(number) if re.fullmatch(r"-?\d+", number) else None

    url = fields.get("WARC-Target-URI")
    url = None if url is None else re.sub(r"%([01][0-9A-F]|20|25|7F)", lambda m: chr(int(m[1], 16)), url)
    return {
        "url_key": url_key(url), "time": fields["WARC-Date"], "page_id": page("WARC-Record-ID"), "url": url,
        "record_type": kind, "refers_to": page("WARC-Refers-To"), "payload_bytes": size, "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, unpacked bytes) of the gzip members of a file, which is read READ_BYTES at a time.

    What an unpacker leaves of a read is copied for the next one, so a read is small."""
    offset, unread = 0, stream.read(READ_BYTES)
    while unread:
        unpacker, length, data = zlib.decompressobj(31), 0, []
        while not unpacker.eof:
            if not unread:
                raise ValueError(f"cut off at byte {offset}")
            data.append(unpacker.decompress(unread))
            length += len(unread) - len(unpacker.unused_data)
            unread = unpacker.unused_data or stream.read(READ_BYTES)
        yield offset, length, b"".join(data)
        offset += length


def capture_order(row) -> tuple:
    """Key, timestamp, id; a null id first. File and place settle what is left."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted iterators with one comparison per level for each item taken.

    Every inner node holds the loser of the match below it and node 0 the overall winner, so that
    after the winner's successor comes in, only the matches on its way up are played again.
    """

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.items = [next(r, None) for r in self.runs]
        self.keys = [None if item is None else key(item) for item in self.items]
        self.tree = [-1] * max(self.k, 1)
        for run in range(self.k):
            self._play(run)

    def _before(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            if self.tree[node] == -1:
                self.tree[node] = run
                return
            if self._before(self.tree[node], run):
                self.tree[node], run = run, self.tree[node]
            node //= 2
        self.tree[0] = run

    def __iter__(self) -> Iterator:
        while self.k and self.items[self.tree[0]] is not None:
            run = self.tree[0]
            yield self.items[run]
            self.items[run] = next(self.runs[run], None)
            self.keys[run] = None if self.items[run] is None else self.key(self.items[run])
            self._play(run)


def read_runs(folder: str, files: DataFrame) -> DataFrame:
    """The captures of all files, each file's in order: the runs, as a written table."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch["file"]:
                rows = []
                with system.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for offset, length, data in members(stream):
                        capture = parse_member(data) | {"file": file, "offset": offset, "length": length}
                        rows.append(tuple(capture[c] for c in _COLUMNS))
                rows.sort(key=capture_order)
                yield pd.DataFrame(rows, columns=_COLUMNS).astype({"page_id": "Int64", "refers_to": "Int64"})

    spread = files.repartition(max(1, min(files.count(), 100_000)), "file")
    return written(spread.mapInPandas(read, CAPTURE), "warc-runs")


def merge_runs(runs: DataFrame, *, range_captures=RANGE_CAPTURES) -> DataFrame:
    """Capture histories in global order: the captures, with range_no and seq (place in the range).

    The bounds of the ranges come from a sample of the captures' order, as with any range partitioning:
    they decide how even the ranges are, and not what the result is.
    """
    rows = runs.count()
    n = max(1, -(-rows // range_captures))
    order = [F.col("url_key"), F.col("time"), F.coalesce(F.col("page_id"), F.lit(_LEAST))]
    bounds: list[tuple] = []
    if n > 1:
        fraction = min(1.0, n * 200 / rows)
        cuts = runs.select(*[c.alias(f"k{i}") for i, c in enumerate(order)]).sample(False, fraction, 42)
        part = cuts.repartitionByRange(n, "k0", "k1", "k2").withColumn("part", F.spark_partition_id())
        lows = part.groupBy("part").agg(F.min(F.struct("k0", "k1", "k2")).alias("low"))
        bounds = sorted(tuple(r.low) for r in lows.collect())[1:]  # one row per range

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts every sorted run at the bounds and packs each piece into one row."""
        for batch in batches:
            rows = [tuple(r.values()) for r in batch.select(_COLUMNS).to_pylist()]
            where = [bisect.bisect_right(bounds, (r[0], r[1], _LEAST if r[2] is None else r[2])) for r in rows]
            cut = [k for k in range(len(rows)) if k == 0 or where[k] != where[k - 1] or rows[k][8] != rows[k - 1][8]]
            packed = [(where[a], _packed(rows[a:b])) for a, b in itertools.pairwise([*cut, len(rows)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in packed], pa.int32()), pa.array([p[1] for p in packed], pa.binary())],
                ["range_no", "piece"],
            )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        pieces = [pa.ipc.open_stream(p).read_all().to_pylist() for p in group["piece"]]
        sorted_rows = [[tuple(r[c] for c in _COLUMNS) for r in rows] for rows in pieces]
        merged = pd.DataFrame(list(LoserTree(sorted_rows, capture_order)), columns=_COLUMNS)
        merged = merged.astype({"page_id": "Int64", "refers_to": "Int64"})
        return merged.assign(range_no=int(group["range_no"].iloc[0]), seq=np.arange(len(merged)))

    pieces = runs.mapInArrow(deal, "range_no int, piece binary")
    return pieces.groupBy("range_no").applyInPandas(merge, CAPTURE + ", range_no int, seq long")


_SCHEMA = pa.schema([
    ("url_key", pa.string()), ("time", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
])


def _packed(rows: list[tuple]) -> bytes:
    columns = zip(*rows, strict=True)
    table = pa.table(dict(zip(_COLUMNS, map(list, columns), strict=True)), schema=_SCHEMA)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _SCHEMA) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def capture_histories(pages: DataFrame, **options) -> tuple[str, DataFrame]:
    """Writes the archive, reads it back and merges its runs: (folder, histories)."""
    folder, files = write_warc(pages, **options)
    return folder, merge_runs(read_runs(folder, files))
