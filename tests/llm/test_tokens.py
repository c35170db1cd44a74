"""Token ids against the tokenizers library; packing against its rules."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, tokens
from tidemark.llm._shared import tokenizer_file

SF = "/root/testdata/sf0.001"
BYTE, WORD = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n a  b\t", "it's  WE'LL 'S don't", "a\x1cb \x85 c　d", "ΣΑΣ ς İstanbul ǅ", "café café ́x", "12 ٣ ½", "🙂👨‍👩 x", "<|endoftext|>a<|startoftext|> b",
    "a" * 3000, "日本" * 500, "x" * 199 + " " + "y" * 201, "​q᠎z", "<|endoftext|", "\x00\x01",
]


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def word():
    return library(WORD), bpe.WordBPE(open(WORD, encoding="utf-8").read())


@pytest.fixture(scope="module")
def byte():
    return library(BYTE), tokens.ByteLevelEncoder(open(BYTE, encoding="utf-8").read(), known_chunks=200)


def test_word_bpe_equals_the_library(word):
    t, own = word
    for x in ODD:
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert own.encode(x) == ids, x
        assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_word_bpe_on_any_text(text):
    t, own = _word()
    assert own.encode(text) == t.encode(text, add_special_tokens=False).ids


_cache = {}


def _word():
    if not _cache:
        _cache["w"] = library(WORD), bpe.WordBPE(open(WORD, encoding="utf-8").read())
        _cache["b"] = library(BYTE), tokens.ByteLevelEncoder(open(BYTE, encoding="utf-8").read(), known_chunks=50)
    return _cache["w"]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_byte_level_on_any_text(text):
    _word()
    t, own = _cache["b"]
    assert np.frombuffer(next(own.encode([text])), own.dtype).tolist() == t.encode(text, add_special_tokens=False).ids


def test_scanning_and_heap_merge_alike(word, monkeypatch):
    _, own = word
    r = random.Random(2)
    for _ in range(200):
        w = "".join(r.choice("abcdeinorst") for _ in range(r.randrange(1, 40)))
        scanned = own.merge(w)
        monkeypatch.setattr(bpe, "LONG", 0)
        assert own.merge(w) == scanned
        monkeypatch.undo()


def test_byte_level_equals_the_library(byte):
    t, own = byte
    texts = [*ODD, *(f"w{i} and, more." for i in range(400)), *ODD]
    packed = list(own.encode(texts))
    assert [np.frombuffer(p, own.dtype).tolist() for p in packed] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert len(own.known) <= 200


def test_codec_query_columns(spark, word):
    t, _ = word
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)] + [(None, "null id"), (3, "again"), (3, "again")], "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    own = bpe.coded(df, ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]).collect()
    assert len(own) == len(ODD) + 3
    by_text = defaultdict(list)
    for r in df.collect():
        by_text[r.doc_id].append(r.text)
    for r in own:
        ids = t.encode(by_text[r.doc_id][0] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        if r.doc_id != 3:
            assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, text)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.coded(df.where("false"), ["ids"]).count() == 0
    with pytest.raises(ValueError):
        bpe.coded(df, ["other"])


def fill(runs):
    """{bin: [(offset, length)]} and the ranks seen, from a plan."""
    bins, ranks = defaultdict(list), defaultdict(list)
    for n, first, count, base, offset, each in runs:
        for i in range(count):
            bins[base + i // each].append((offset + i % each * n, n))
        ranks[n].extend(range(first, first + count))
    return bins, ranks


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=20), st.just(60))
def test_plan_places_every_piece_once(histogram, capacity):
    bins, ranks = fill(packing.plan(histogram, capacity))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for content in bins.values():
        content.sort()
        assert content[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(content, content[1:]))
        assert content[-1][0] + content[-1][1] <= capacity
        assert sum(3 * n > capacity for _, n in content) <= 2
    assert sorted(bins) == list(range(len(bins)))


def best_fit_decreasing(lengths, capacity):
    """Piece by piece: large ones matched, the rest best-fit."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    gaps = []
    while large:
        n = large.pop(0)
        i = next((i for i, m in enumerate(large) if n + m <= capacity), None)
        gaps.append(capacity - n - (large.pop(i) if i is not None else 0))
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_is_as_good_as_piece_by_piece(lengths):
    bins, _ = fill(packing.plan(Counter(lengths), 50))
    assert len(bins) == best_fit_decreasing(lengths, 50)


def pieces(rows, t, capacity=2048, end=0):
    out = []
    for doc, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        size = (len(ids) - 1) % capacity + 1
        start = piece = 0
        while start < len(ids):
            out.append((doc, piece, start, size, zlib.crc32(ids[start : start + size].tobytes())))
            start, size, piece = start + size, capacity, piece + 1
    return sorted(out, key=str)


def test_packing_documents(spark):
    t = library(BYTE)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    own = packing.packed(docs).collect()
    assert sorted((tuple(r)[:5] for r in own), key=str) == pieces([(r.doc_id, r.text) for r in docs.collect()], t)
    bins = defaultdict(list)
    for r in own:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        content.sort()
        assert content[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(content, content[1:])) and content[-1][0] + content[-1][1] <= 2048
    assert len(bins) <= sum(r.length for r in own) / 2048 * 1.05 + 1


def test_packing_edge_cases_and_sequences(spark):
    t = library(BYTE)
    rows = [(1, None), (1, None), (2, ""), (None, "null id"), (3, "word " * 30_000), (3, "word " * 30_000), (4, "x " * 2046), (5, "y " * 2047)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as length", "2 as part", "3 as sequence_id")
    own = packing.packed(df, keep_ids=True)
    got = own.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == pieces(rows, t)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(own).collect()}
    for r in got:
        assert zlib.crc32(whole[r.sequence_id][r.offset : r.offset + r.length].tobytes()) == r.ids_crc32
    assert max(map(len, whole.values())) <= 2048
    assert packing.packed(df.where("false")).count() == 0
