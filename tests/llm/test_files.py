import base64
import gzip
import hashlib
import io
import itertools
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from prefspark.llm import token_files, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def brute_tokens(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("files", [None, 5])
def test_token_files(spark, documents, texts, tokenizer, files):
    folder, listing = token_files.write_token_files(documents, PATH, files=files)
    rows = token_files.read_token_files(folder, listing).collect()
    want = {w[0]: w[1:] for w in brute_tokens(tokenizer, list(texts.items()))}
    assert {r.id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 2 for r in rows)


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "don't", "'s", "12", ".", ",!", "é", "ñu", "\xa0", "　", "\x1c", "​", "<|endoftext|>", "\0", "\r\n", "日本", "\U0001f600", "'", "x's y"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) for _ in range(3000)]
    encoder = token_files.Encoder(PATH)
    for at in range(0, 3000, 500):
        got = encoder.encode(texts[at : at + 500])
        for text, ids in zip(texts[at : at + 500], got, strict=True):
            assert np.frombuffer(ids, dtype="<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_shuffled_reads_and_damage(spark, documents):
    folder, listing = token_files.write_token_files(documents, PATH, files=1)
    name = listing.first().file
    system, root = fs.FileSystem.from_uri(folder)
    index = token_files.read_index(system.open_input_stream(f"{root}/{name}.idx").read())
    raw = system.open_input_stream(f"{root}/{name}.tok").read()
    whole = {r.id: r.ids for r in token_files.read_token_files(folder, listing).collect()}
    for k in random.Random(1).sample(range(len(index)), 20):
        assert token_files.read_record(memoryview(raw), int(index[k]["offset"])).tolist() == whole[int(index[k]["id"])]
    for place in (9, 13, 25):
        damaged = bytearray(raw)
        damaged[place] ^= 1
        with pytest.raises(ValueError):
            token_files.read_record(memoryview(bytes(damaged)), 8)


def test_token_edge_cases(spark, edge_docs, no_docs, tokenizer):
    folder, listing = token_files.write_token_files(edge_docs, PATH, files=3)
    got = [(r.id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(folder, listing, with_ids=False).collect()]
    want = brute_tokens(tokenizer, [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert Counter(got) == Counter((i, n, c) for i, _, n, c in want)
    folder, listing = token_files.write_token_files(no_docs, PATH)
    assert token_files.read_token_files(folder, listing).collect() == []


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def check_pages(rows, pages):
    groups = defaultdict(list)
    for p in pages:
        groups[p.html or ""].append(p.page_id)
    assert len(rows) == len(pages)
    by_id = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    want = Counter()
    for p in pages:
        ids = [i for i in groups[p.html or ""] if i is not None]
        response = max(ids) if ids else None
        same = p.page_id == response
        want[p.page_id, len((p.html or "").encode()), digest(p.html), "response" if same else "revisit", None if same else response] += 1
    assert by_id == want


def check_order(histories):
    rows = sorted(histories.collect(), key=lambda r: (r.range_no, r.seq))
    keys = [(r.url_key, r.time, r.page_id is not None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)
    return rows


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    folder, files = warc.write_warc(pages.repartition(4), file_bytes=100_000)
    assert files.count() > 4
    rows = check_order(warc.merge_runs(warc.read_runs(folder, files), range_captures=40))
    assert len({r.range_no for r in rows}) > 3
    check_pages(rows, pages.collect())
    # Records are where the index says, and hold the page.
    html = {p.page_id: p.html for p in pages.collect()}
    system, root = fs.FileSystem.from_uri(folder)
    for r in rows[::25]:
        raw = system.open_input_stream(f"{root}/{r.file}", compression=None).read()[r.offset : r.offset + r.length]
        record = warc.parse_member(zlib.decompress(raw, 31))
        assert record["page_id"] == r.page_id and record["url"] == r.url
        assert r.record_type == "revisit" or record["payload"].decode() == html[r.page_id]


def test_page_edge_cases(spark):
    schema = "page_id long, url string, html string, time string, payload long, size string"
    rest = ("t", 1, "s")
    rows = [(1, "http://a.com/x", None, *rest), (2, "HTTP://WWW.A.com:80/x?b=1&a=2", "", *rest), (3, None, "p", *rest), (None, "http://a.com/", "p", *rest),
            (4, "no url \n at all", "p", *rest), (5, "http://[bad", "q" * 100_000, *rest), (6, "http://sub.a.com/é%20", "Content-Length: 3\r\n\r\nx", *rest)]
    rows += [(7, "http://hot.com/", "h", *rest)] * 30
    pages = spark.createDataFrame(rows, schema)
    _, histories = warc.capture_histories(pages, file_bytes=10_000)
    found = check_order(histories)
    check_pages(found, pages.collect())
    assert Counter(r.url for r in found) == Counter(r[1] for r in rows)
    folder, histories = warc.capture_histories(pages.limit(0))
    assert histories.collect() == []


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(k, "http://a.com/", "x" * n) for n in (3, 30) for k in range(n, n + 3)], "page_id long, url string, html string")
    _, histories = warc.capture_histories(pages, min_revisit_bytes=10)
    assert Counter((r.payload_bytes, r.record_type) for r in histories.collect()) == {(3, "response"): 3, (30, "response"): 1, (30, "revisit"): 2}


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20), r, i) for i in range(rng.randrange(0, 30))) for r in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(itertools.chain(*runs))


class Archive(io.RawIOBase):
    """A file of gzip members that is made while it is read, so that it needs no memory."""

    def __init__(self, member, n):
        self.member, self.left, self.rest, self.longest = member, n, b"", 0

    def read(self, size):
        self.longest = max(self.longest, size)
        while len(self.rest) < size and self.left:
            self.rest, self.left = self.rest + self.member, self.left - 1
        out, self.rest = self.rest[:size], self.rest[size:]
        return out


def test_archives_are_read_in_time_and_memory_that_their_size_allows():
    member = gzip.compress(random.Random(1).randbytes(3000))
    took = {}
    for megabytes in (8, 64):
        n = (megabytes << 20) // len(member)
        archive, start = Archive(member, n), time.process_time()
        tracemalloc.start()
        count = end = 0
        for offset, length, data in warc.members(archive):
            assert (offset, length, len(data)) == (end, len(member), 3000)
            count, end = count + 1, offset + length
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        took[megabytes] = time.process_time() - start
        assert count == n and archive.longest == warc.READ_BYTES and peak < 1 << 20
    assert took[64] < 8 * took[8] * 2


@pytest.mark.parametrize("size", [1, 7, 64 << 10])
def test_members_of_any_size(monkeypatch, size):
    monkeypatch.setattr(warc, "READ_BYTES", size)
    texts = [b"", b"a", random.Random(1).randbytes(50_000), b"b" * 100_000]
    raw = b"".join(map(gzip.compress, texts))
    assert [data for _, _, data in warc.members(io.BytesIO(raw))] == texts
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(io.BytesIO(raw[:-1])))
    assert list(warc.members(io.BytesIO(b""))) == []
