"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from signal_lake.llm import phrase_mining as P
from signal_lake.llm.common import lookup_salted


def plain_counts(rows):
    """{(lang, phrase): f} for phrases of 1 to 3 words, by slicing."""
    counts = Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", " ".join(words[i : i + k])] += 1
    return counts


def plain_phrases(rows, least, first):
    counts = plain_counts(rows)
    n = Counter()
    for (lang, phrase), f in counts.items():
        if " " not in phrase:
            n[lang] += f
    found = defaultdict(list)
    candidates = {k: f for k, f in counts.items() if " " in k[1] and f >= least}
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        held = [f for (other, longer), f in candidates.items() if other == lang and longer != phrase and f" {phrase} " in f" {longer} "]
        if not any(100 * f >= 50 * a for f in held):
            found[lang].append((score, a, phrase, left, right))
    rows = []
    for lang, some in found.items():
        some.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        rows += [(lang, i, phrase, a, left, right, n[lang], score) for i, (score, a, phrase, left, right) in enumerate(some[:first], 1)]
    return sorted(rows)


def some_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "SAT", "on", "Äpfel", "äpfel", "日本", "x\x1cy", "a", "b"] + [f"w{i}" for i in range(15)]
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "\x0b", ":", "!?"]
    rows = [("".join(rng.choice(words[: rng.randrange(2, len(words))]) + rng.choice(marks) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None])) for _ in range(n)]
    return rows + [(None, "en"), ("", "fr"), (" .,; ", "fr"), ("und und", "und")] + [("the cat sat on the cat sat", "en")] * 12 + [("go go go go go go " * 500, "de")]


def mined(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "text string, lang string")
    return sorted(tuple(r) for r in P.mine_phrases(docs, **settings).collect())


def test_phrases_are_those_of_plain_counting(spark):
    rows = some_rows(1)
    assert mined(spark, rows, least=4, first=50, block_tokens=300) == plain_phrases(rows, 4, 50)


def test_defaults(spark):
    rows = some_rows(2, 60) * 5
    want = plain_phrases(rows, 10, 2000)
    assert want and mined(spark, rows) == want


def test_border_failures_are_expanded_until_closed(spark):
    rows = some_rows(3)
    docs = spark.createDataFrame(rows, "text string, lang string")
    blocks = P._blocks(docs, F.col("text"), F.col("lang"), 500)
    frequent, failed = P.frequent_phrases(blocks, 5, proposed=P.Proposed())
    got = {(r.lang, r.phrase): r.f for r in frequent.collect()}
    want = {k: f for k, f in plain_counts(rows).items() if f >= 5}
    assert got == want and frequent.count() == len(want)
    assert len(failed) == 3 and failed[0] > 0 and failed[-1] == 0  # nothing was proposed: each pass gets one word further
    assert any(k[1].count(" ") == 2 for k in want)


def test_shared_bits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "_bits_for", lambda count: 3)
    rows = some_rows(4)
    docs = spark.createDataFrame(rows, "text string, lang string")
    blocks = P._blocks(docs, F.col("text"), F.col("lang"), 400)
    frequent, _ = P.frequent_phrases(blocks, 5)
    assert {(r.lang, r.phrase): r.f for r in frequent.collect()} == {k: f for k, f in plain_counts(rows).items() if f >= 5}


def test_counts_beyond_64_bits_are_exact(spark):
    a, left, right = 999_999_999_999_937, 999_999_999_999_989, 9_999_999_999_999_999
    frequent = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right)], "lang string, phrase string, length int, f bigint")
    (row,) = P.scored_phrases(frequent).collect()
    assert row.score == 1000000 * a * a // (left * right)
    exact = spark.createDataFrame([("en", "x y", 2, 10**15), ("en", "x", 1, 10**15), ("en", "y", 1, 10**15 + 1)], "lang string, phrase string, length int, f bigint")
    assert P.scored_phrases(exact).first().score == 999_999


def test_a_phrase_inside_longer_ones_goes(spark):
    rows = [("en", p, 2 if p.count(" ") == 1 else 3, a, 1, 5, 5, 5) for p, a in (("a b", 20), ("b c", 21), ("a b c", 10), ("x x", 40), ("x x x", 20), ("d e", 10))]
    scored = spark.createDataFrame(rows, "lang string, phrase string, length int, a bigint, cut int, l bigint, r bigint, score bigint")
    assert sorted(r.phrase for r in P.without_covered(scored).collect()) == ["a b c", "b c", "d e", "x x x"]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    found = P.mine_phrases(odd_docs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r.text, r.lang) for r in odd_docs.select("text", "lang").collect()]
    assert sorted(tuple(r) for r in found.collect()) == plain_phrases(rows, 10, 2000)
    assert P.mine_phrases(no_docs).collect() == []


def test_lookup_by_key_and_salt(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3 * (F.col("id") % 10 == 0).cast("int")).alias("k"))
    table = spark.createDataFrame([(0, "zero"), (2, "two"), (9, "nine")], "k int, v string")
    got = Counter((r.k, r.v) for r in lookup_salted(rows, table, ["k"], ["id"], salts=8).collect())
    want = Counter((r.k, {0: "zero", 2: "two"}[r.k]) for r in rows.collect() if r.k in (0, 2))
    assert got == want


def test_maps_hold_what_was_put_in():
    hashes = np.random.default_rng(0).integers(0, 1 << 64, 300, dtype=np.uint64)
    bits = np.zeros(1 << 13, np.uint8)
    for h in hashes:
        at = int(h) >> (64 - 16)
        bits[at >> 3] |= 1 << (at & 7)
    held = P.Proposed().with_map(1, bits)
    assert held.has(1, hashes).all() and not held.has(2, hashes).any()
    others = np.random.default_rng(1).integers(0, 1 << 64, 3000, dtype=np.uint64)
    assert held.has(1, others).mean() < 0.02
