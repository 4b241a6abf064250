"""Packing against the tokenizer and the rules of a packing."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from signal_lake.llm import packing as P
from signal_lake.llm.catalog import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer())


def check(pieces, texts, tokenizer, size=P.SIZE):
    """``pieces`` cover every document's ids once, and fill sequences without gaps."""
    want = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), size):
            part = np.array(ids[start : start + size], dtype="<u4")
            want[doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == want
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return {k: sum(n for _, n in v) for k, v in sequences.items()}


def test_whole_table(spark, small_sf, tokenizer):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect()
    filled = check(QUERIES["op6_packing"](spark, small_sf).collect(), [(r.doc_id, r.text) for r in docs], tokenizer)
    assert sum(P.SIZE - n for n in filled.values()) <= 0.05 * sum(filled.values())


def test_odd_documents(spark, odd_docs, no_docs, tokenizer):
    rows = odd_docs.select("doc_id", "text").collect()
    check(P.pack(odd_docs).collect(), [(r.doc_id, r.text) for r in rows], tokenizer)
    assert P.pack(no_docs).collect() == []
    kept = P.pack(odd_docs, keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in kept)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_patterns_hold_the_histogram(histogram):
    patterns = P.shortest_pack_first(histogram, 64)
    held = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 64 and list(pattern) == sorted(pattern, reverse=True)
        for length in pattern:
            held[length] += count
    assert held == Counter(histogram)
    rows = P.intervals(patterns)
    for length, count in histogram.items():
        ranks = [r for first, past in ((a, b) for n, a, b, _, _ in rows if n == length) for r in range(first, past)]
        assert sorted(ranks) == list(range(count))


def test_both_libraries_give_the_same_ids(tokenizer):
    tokens = P.tokens(P.default_tokenizer())
    texts = ["", "a", "It's  naïve – «çé» ½ 1234\r\n\t x", "日本語 🙂 \u0000", "<|endoftext|> is text", "    \x0b", "a" * 5000]
    assert tokens.fast is not None
    assert [list(i) for i in tokens.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings_are_special_tokens(spark, tokenizer):
    texts = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 3), (3, "ä 日本 <|endoftext|>"), (4, "<|endoftext|"), (5, "a")]
    assert P.tokens(P.default_tokenizer()).encode([texts[0][1]])[0].tolist() == [64, 220, 50256, 275]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    check(P.pack(docs, "doc_id", "text").collect(), texts, tokenizer)
