"""Encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from signal_lake.llm import sentencepiece_codec as S

from odd_rows import ROWS  # type: ignore[import-not-found]


@pytest.fixture(scope="module")
def codec():
    return S.Codec(S.default_model())


def encoded(codec, texts):
    flat, bounds = codec.encode(texts)
    return [[codec.begin, *flat[a:b].tolist(), codec.end] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" eatshrondil\n.,▁THE01"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_any_text_is_encoded_and_decoded_as_by_the_library(texts):
    codec = S.codec(S.default_model())
    want = [codec.library.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert encoded(codec, texts) == want
    assert [codec.decode(i) for i in want] == [codec.library.decode(i) for i in want]


def test_long_chunks_and_runs_of_blanks(codec):
    texts = ["a" * 4000, "the" * 500, " " * 70, "x" + " " * 33 + "y", "\n" * 40, "日本" * 300, "e" * S.LONG, "e" * (S.LONG + 1)]
    assert encoded(codec, texts) == [codec.library.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_both_agendas_agree(codec):
    rng = random.Random(5)
    chunks = ["".join(rng.choice("▁etaoinshrdlu.é") for _ in range(12)) for _ in range(400)]
    assert codec.merge_many(chunks) == [codec.merge_one(c) for c in chunks]


def test_any_ids_are_decoded_as_by_the_library(codec):
    rng = random.Random(7)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999), codec.ids["▁"]]) for _ in range(rng.randint(0, 9))]
        assert codec.decode(ids) == codec.library.decode(ids), ids


def test_forgetting_known_chunks_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(S, "KNOWN", 3)
    texts = ["one two three four", "two three", "five one"]
    assert encoded(codec, texts) == [codec.library.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_odd_documents(spark, odd_docs, no_docs, codec):
    rows = S.digests(S.encode_documents(odd_docs, "doc_id", "text")).collect()
    want = []
    for doc_id, text, _ in ROWS:
        ids = codec.library.encode(text or "", add_bos=True, add_eos=True)
        data = np.array(ids, dtype="<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(codec.library.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert S.digests(S.encode_documents(no_docs, "doc_id", "text")).collect() == []
