"""Scores against a plain model in Python."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from signal_lake.llm import catalog, lm_scoring
from signal_lake.llm.token_blocks import pack_ints, pack_sorted, share_of, unpack_ints, unpack_sorted


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def contexts_of(words, m):
    """Context of each token for the m-gram: words since the beginning of the text."""
    return [tuple(["<s>", *words[:i]][-(m - 1):]) if m > 1 else () for i in range(len(words))]


def plain_scores(rows, deleted, order, rounds=lm_scoring.ROUNDS):
    """{id: (held_out, n_tokens, n_known, train_tokens, base, score)} by dictionaries."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    counts = {part: [Counter() for _ in range(order + 1)] for part in ("all", "kept")}
    for i, text in rows:
        if held[i]:
            continue
        words = tokens_of(text)
        for m in range(1, order + 1):
            for context, word in zip(contexts_of(words, m), words, strict=True):
                for part in ("all",) if i in deleted else ("all", "kept"):
                    counts[part][m][(*context, word)] += 1
                    counts[part][m][("context", *context)] += 1
    words_known = {k for k in counts["all"][1] if k[0] != "context"}
    total, v = counts["all"][1][("context",)], len(words_known)

    def levels(part, words, i):
        found = []
        for m in range(1, order + 1):
            context = contexts_of(words, m)[i]
            found.append((counts[part][m][(*context, words[i])], counts[part][m][("context", *context)]))
        return found

    weights = {}

    def chances(found):
        p = [1 / (v + 1)]
        for m, (c, n) in enumerate(found, 1):
            w = weights.get((m, n.bit_length()), 0.5) if n else 0.0
            p.append(w * c / max(n, 1) + (1 - w) * p[-1])
        return p

    evidence = Counter(tuple(levels("kept", tokens_of(t), i)) for d, t in rows if d in deleted and not held[d] for i in range(len(tokens_of(t))))
    before = None
    for _ in range(rounds):
        taken, passed, now = Counter(), Counter(), 0.0
        for found, times in evidence.items():
            p = chances(found)
            now += times * math.log(p[-1])
            mass = times
            for m in range(order, 0, -1):
                c, n = found[m - 1]
                if n:
                    w = weights.get((m, n.bit_length()), 0.5)
                    own = mass * w * c / n / p[m]
                    taken[m, n.bit_length()] += own
                    passed[m, n.bit_length()] += mass - own
                    mass -= own
        weights = {k: (taken[k] + 0.5) / (taken[k] + passed[k] + 1) for k in taken.keys() | passed.keys()}
        if before is not None and now - before <= lm_scoring.ENOUGH * abs(before):
            break
        before = now
    result = []
    for d, text in rows:
        words = tokens_of(text)
        c1 = [counts["all"][1][(w,)] for w in words]
        score = sum(math.log10(chances(levels("all", words, i))[-1]) for i in range(len(words)))
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (v + 1))) for c in c1)
        result.append((d, held[d], len(words), sum(c > 0 for c in c1), total, base, score))
    return result


def run(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = docs.select("doc_id", (F.pmod(F.xxhash64(F.lit("deleted"), F.col("doc_id").cast("string")), F.lit(10)) == 1).alias("d"))
    deleted = {r.doc_id for r in ids.collect() if r.d}
    found = lm_scoring.score_documents(docs, **settings)
    return [tuple(r) for r in found.collect()], deleted


def same(got, want):
    def key(r):
        return repr(r[:5])

    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=lambda r: (key(r), r[6])), sorted(want, key=lambda r: (key(r), r[6])), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_a_plain_model(spark, monkeypatch, order):
    monkeypatch.setattr(lm_scoring, "ROUNDS", 5)
    rng = random.Random(order)
    words = ["The", "the", "cat", "sat", "on", "a", "mat", "Äpfel", "äpfel", "日本"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights=[50 / (k + 1) for k in range(len(words))], k=rng.randrange(0, 30)))) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(10)] + [(300, None), (301, ""), (302, " \t\n"), (5, "cat again"), (None, "the cat"), (303, "a " * 3000)]
    got, deleted = run(spark, rows, order=order, block_tokens=200, part_keys=64)
    same(got, plain_scores(rows, deleted, order, 5))


def test_more_parts_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "ROUNDS", 2)
    rows = [(i, f"x y z{i % 7} x y {i}") for i in range(200)]
    one, _ = run(spark, rows, order=2)
    many, _ = run(spark, rows, order=2, block_tokens=10, part_keys=5)
    same(one, many)


def test_probabilities_of_all_words_add_up_to_one():
    rng = np.random.default_rng(0)
    n = 50
    counts = [rng.integers(0, 9, n) for _ in range(3)]
    contexts = [np.full(n, c.sum()) for c in counts]
    chance = lm_scoring.mixed(counts, contexts, np.full((3, lm_scoring.BUCKETS), 0.7), n)[-1]
    unknown = 0.3**3 / (n + 1)
    assert chance.sum() + unknown == pytest.approx(1.0)


def test_empty_and_untaught(spark):
    assert run(spark, [], order=2)[0] == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    got, _ = run(spark, [(held, "alone here")], order=2)
    assert got == [(held, True, 3, 0, 0, 0.0, 0.0)]


def test_odd_rows(spark, monkeypatch, odd_docs):
    monkeypatch.setattr(lm_scoring, "ROUNDS", 3)
    found = lm_scoring.score_documents(odd_docs)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = found.collect()
    texts = sorted((r.doc_id is not None, r.doc_id or 0, len(tokens_of(r.text))) for r in odd_docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in rows) == texts
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_packing_of_numbers():
    rng = np.random.default_rng(1)
    for values in ([], [0], [255, 256, 0], rng.integers(0, 1 << 62, 100)):
        assert unpack_ints(pack_ints(np.array(values, np.int64))).tolist() == list(values)
    keys = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (unpack_sorted(pack_sorted(keys)) == keys).all()
    assert (np.diff(share_of(keys, 37)) >= 0).all() and share_of(keys, 37).max() == 36


def test_query_scores_better_than_its_base(spark, small_sf):
    rows = catalog.QUERIES["op11_lm_scoring"](spark, small_sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {d: len(tokens_of(t)) for d, t in docs.items()}
    known = Counter(w for d, t in docs.items() if zlib.crc32(str(d).encode()) % 10 for w in tokens_of(t))
    total = sum(known.values())
    for r in rows:
        words = tokens_of(docs[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) and r.train_tokens == total
        assert r.n_known == sum(known[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((known[w] + 0.1) / (total + 0.1 * (len(known) + 1))) for w in words), rel=1e-9)
    out = [r for r in rows if r.held_out]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)
