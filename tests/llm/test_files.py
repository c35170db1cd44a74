"""WARC archives and token records: exact round trips, order, digests, damage."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import records, warc
from tidemark.llm._shared import shared_dir, tokenizer_file

SF = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://a", "<p>one</p>"), (2, "http://b\r\nx: y", "<p>two</p>"), (3, None, "<p>one</p>"), (3, None, "<p>one</p>"), (4, "http://d", None), (5, "http://e", ""),
    (None, "http://f", "<p>one</p>"), (None, "http://g", "only null"), (None, "http://h", "only null"), (9, "http://é", "ü" * 300_000), (10, "u", "\r\n\r\n"),
]


def wanted(pages, least=0):
    groups = defaultdict(list)
    for i, _, html in pages:
        groups[html or ""].append(i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        best = max((x for x in groups[html or ""] if x is not None), default=None)
        refers = best if len(data) >= least and best is not None and len(groups[html or ""]) > 1 and i != best else None
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as payload_bytes", "2 as record_type")
    for least in (0, 5, 100):
        assert sorted((tuple(r) for r in warc.round_trip(df, least).collect()), key=str) == wanted(PAGES, least)
    assert warc.round_trip(df.where("false")).count() == 0


def test_warc_of_pages_and_payloads(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == wanted(rows)
    m = warc.write_archives(pages, f"file://{tmp_path}/w", archive_bytes=20_000)
    assert m.count() > 1
    own = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc.read_archives(m, keep_payload=True).collect() if r.record_type == "response"}
    assert all(own[i] == (u, h) for i, u, h in rows if i in own) and len(own) == len({h for _, _, h in rows})


def test_a_member_per_record(spark, tmp_path):
    data = warc.record(1, "http://a", b"x" * 100) + warc.record(2, None, b"")
    path = tmp_path / "two.warc.gz"
    path.write_bytes(data)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    own = list(warc.read_archive(str(path), keep_payload=True))
    assert [(r.payload_bytes, r.payload) for r in own] == [(100, b"x" * 100), (0, b"")]


@pytest.mark.parametrize("harm", ["cut", "digest", "length", "garbage"])
def test_damaged_archives_are_told(tmp_path, harm):
    good = gzip.decompress(warc.record(1, "http://a", b"payload bytes"))
    data = {
        "cut": warc.record(1, "http://a", b"payload bytes")[:-9],
        "digest": gzip.compress(good.replace(b"payload bytes", b"payload bytez")),
        "length": gzip.compress(good.replace(b"msgtype=response\r\nContent-Length: 9", b"msgtype=response\r\nContent-Length: 8")),
        "garbage": b"no gzip at all, just text",
    }[harm]
    path = tmp_path / "bad.warc.gz"
    path.write_bytes(data)
    with pytest.raises(warc.CorruptArchive):
        list(warc.read_archive(str(path)))


def test_a_revisit_without_its_response_is_told(spark):
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    good = [(1, 5, "A", "revisit", 3), (3, 5, "A", "response", None), (2, 0, "B", "response", None), (None, 5, "A", "revisit", 3)]
    assert sorted(map(tuple, warc.checked_revisits(spark.createDataFrame(good, schema)).collect()), key=str) == sorted(good, key=str)
    for bad in ((1, 5, "A", "revisit", 2), (1, 5, "C", "revisit", 3), (1, 6, "A", "revisit", 3), (1, 5, "A", "revisit", None)):
        with pytest.raises(Exception, match="no response for the revisit of page 1"):
            warc.checked_revisits(spark.createDataFrame([bad, *good[1:]], schema)).collect()


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def record_rows(rows, tokenizer):
    out, start = [], 0
    coded = [(d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for d, t in rows]
    # Of rows with one id those with less tokens' bytes first; without the end id, which would take part in the order.
    for doc, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, r[1][:-1].astype("<u2").tobytes())):
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_records_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    own = sorted((tuple(r) for r in records.round_trip(docs).collect()), key=lambda r: r[1])
    assert own == record_rows(rows, tokenizer)


def test_records_edge_cases(spark, tokenizer):
    rows = [(3, None), (1, "hello <|endoftext|> there"), (1, "hello"), (None, "no id"), (2, ""), (5, "long " * 60_000), (-4, "\n\n  x"), (5, "a" * 3000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 as start", "2 as n_tokens")
    own = sorted((tuple(r) for r in records.round_trip(df).collect()), key=lambda r: r[1])
    assert own == record_rows(rows, tokenizer)
    assert records.round_trip(df.where("false")).count() == 0


def test_records_over_many_files(spark, tokenizer):
    """Files of a few hundred bytes; one id and no id hold a third of the rows each."""
    r = random.Random(2)
    rows = [(r.choice([None, 7, i]), f"text {i} " * r.randrange(5)) for i in range(-100, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    manifest = records.write_records(df, f"{shared_dir(spark)}/records", file_bytes=400)
    files = manifest.collect()
    assert len(files) > 10 and max(f.docs for f in files) < 60 and sum(f.docs for f in files) == len(rows)
    own = sorted((tuple(r) for r in records.record_digests(manifest).collect()), key=lambda r: r[1])
    assert [(d is not None, d or 0) for d, *_ in own] == sorted((d is not None, d or 0) for d, *_ in own)
    assert [s for _, s, *_ in own] == [sum(n for _, _, n, _ in own[:i]) for i in range(len(own))]
    assert sorted(((d, n, c) for d, _, n, c in own), key=str) == sorted(((d, n, c) for d, _, n, c in record_rows(rows, tokenizer)), key=str)


def test_shuffled_reads_and_ids(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string")
    m = records.write_records(docs, f"file://{tmp_path}/r").collect()
    plain = [(d, i.tolist()) for r in m for d, i in records.read_file(r.uri)]
    mixed = [(d, i.tolist()) for r in m for d, i in records.read_shuffled(r.uri, r.index_uri, 3)]
    assert plain != mixed and sorted(plain) == sorted(mixed)
    assert [d for d, _ in plain] == list(range(50))
    own = records.read_records(spark.createDataFrame(m)).orderBy("start").collect()
    assert [(r.doc_id, r.ids) for r in own] == plain


def test_damaged_records_are_told(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some text"), (2, "more text")], "doc_id long, text string")
    uri = records.write_records(docs.coalesce(1), f"file://{tmp_path}/r").first().uri
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    for at in (10, 30, len(data) - 2):
        bad = bytearray(data)
        bad[at] ^= 1
        (tmp_path / "bad").write_bytes(bad)
        with pytest.raises(records.CorruptRecord):
            list(records.read_file(str(tmp_path / "bad")))
    (tmp_path / "bad").write_bytes(data[:-3])
    with pytest.raises(records.CorruptRecord):
        list(records.read_file(str(tmp_path / "bad")))
