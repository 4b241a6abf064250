"""Near-duplicate classes against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from signal_lake.llm import minhash_dedup as M


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_components(texts):
    """Component of each text by comparing all pairs: the index of its first member."""
    sets = [plain_set(t) for t in texts]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * len(a & b) >= 3 * len(a | b) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


def family(rng, n, heavy):
    """Copies of one text with edits of different weight, many of them near the threshold."""
    words = [f"w{rng.randrange(5000)}" for _ in range(90)]
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randrange(heavy)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def families():
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rng, 60, 4) + family(rng, 60, 9) + family(rng, 5, 2) * 3
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(50)]
    rng.shuffle(texts)
    return texts


def test_families_against_all_pairs(spark, families, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 8)  # so that buckets are cut into chunks
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(families)], "doc_id bigint, text string")
    rows = M.near_duplicates(docs).collect()
    want = plain_components(families)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(want))
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(plain_set(t)) for i, t in enumerate(families)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert 5 < len(set(want)) < len(families)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = M.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert Counter(r.doc_id for r in rows)[7] == 2
    by_id = {r.doc_id: r for r in rows}
    for doc_id in (2, 3, 4):
        assert (by_id[doc_id].n_shingles, by_id[doc_id].component_id, by_id[doc_id].kept) == (0, doc_id, True)
    assert by_id[11].component_id == 1 and not by_id[11].kept
    assert by_id[13].component_id == 12 and by_id[13].n_shingles == 1  # case and blanks make no difference
    assert by_id[None].component_id is None and by_id[None].kept
    assert {r.component_id for r in rows if r.doc_id == 8} == {8}
    assert M.near_duplicates(no_docs).collect() == []


def test_sketches_are_full_and_estimate_similarity():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 5, 40, 2000)]
    sketch = M.sketches([*sets, np.zeros(0, dtype=np.uint64)])
    assert (sketch[:-1] != M._EMPTY).all() and (sketch[-1] == M._EMPTY).all()
    assert ((sketch[4] >> 32) <= 2).all()  # a large set is done after few rounds
    for share in (0.5, 0.75, 0.9):
        found = []
        for _ in range(60):
            whole = rng.integers(0, 2**63, 300, dtype=np.uint64)
            common = int(round(2 * share / (1 + share) * 200))
            a, b = whole[:200], np.concatenate([whole[:common], whole[200 : 400 - common]])
            pair = M.sketches([np.unique(a), np.unique(b)])
            found.append((pair[0] == pair[1]).mean())
        exact = common / (400 - common)
        assert abs(np.mean(found) - exact) < 0.03


def test_shared_counts():
    rng = random.Random(1)
    sets = [np.array(sorted(rng.sample(range(60), rng.randrange(0, 40))), dtype=np.int64) for _ in range(12)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[5:]] for a in sets[:5]]
    assert M.shared(sets[:5], sets[5:]).tolist() == want
