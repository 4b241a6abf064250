"""Base measures and fertility against plain counts; labelled documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from signal_lake.llm import quality_rules as Q
from signal_lake.llm.catalog import QUERIES


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by the definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def bits(ids):
    counts = Counter(ids)
    return -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values()) if ids else 0.0


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as P

    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def verdict(text, lang, libraries):
    n, chars, _, _, repeated = base(text)
    if n < 50 or 100 * repeated > 50 * n:
        return True, False
    pieces, tokens = libraries[0].encode(text), libraries[1].encode(text, add_special_tokens=False).ids
    for name, ids in (("piece", pieces), ("byte", tokens)):
        band = Q.BANDS.get((name, lang)) or Q.BANDS[name, "latin"]
        share = sum(libraries[0].is_byte(i) and chr(int(libraries[0].id_to_piece(i)[3:5], 16)) not in Q.BLANKS for i in ids) / len(ids) if name == "piece" else 0
        a, b, c = Q.CURVE[name]
        x = min(math.log2(len(ids)), -b / (2 * c))
        if not band.least_chars <= chars / len(ids) <= band.most_chars or share > band.most_bytes or bits(ids) - (a + b * x + c * x * x) < band.least_entropy - Q.SLACK / math.sqrt(len(ids)):
            return False, False
    return False, True


def test_whole_table_against_plain_counts(spark, small_sf, libraries):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    rows = QUERIES["op3_quality_rules"](spark, small_sf).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        doc = docs[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(doc.text)
        assert (r.base_failed, r.kept) == verdict(doc.text, doc.lang, libraries)


def test_good_documents_stay_and_junk_goes(spark, small_sf):
    sf = small_sf.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op3_quality_rules"](spark, sf).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    junk = [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in junk) >= 0.7 * len(junk)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("a b c d aa".split()), max_size=30))
def test_repeated_words(words):
    assert Q.repeated_words([w.encode() for w in words]) == base(" ".join(words))[4]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = Q.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = Counter((r.doc_id, *base(r.text)) for r in odd_docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == texts
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].base_failed and not by_id[2].kept and by_id[7].base_failed  # no text; one line again and again
    assert Q.judge(no_docs).collect() == []
    assert Q.judge(odd_docs, language_column=None).count() == len(rows)


def test_other_scripts_take_their_own_band():
    assert (Q.script("Прочее и другое"), Q.script("日本語 text"), Q.script("naïve – text"), Q.script("123")) == ("other", "latin", "latin", "other")
