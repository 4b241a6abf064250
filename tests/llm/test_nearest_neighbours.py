"""Nearest neighbours against all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from signal_lake.llm import nearest_neighbours as N
from signal_lake.llm.catalog import QUERIES


def plain(ids, vectors, query_ids, k=5):
    """(query_id, rank, vec_id, score) of all pairs."""
    out = []
    for q in query_ids:
        at = next(i for i, v in enumerate(ids) if v == q)
        a = np.asarray(vectors[at], dtype=np.float64)
        scored = []
        for i, v in enumerate(ids):
            b = np.asarray(vectors[i], dtype=np.float64)
            if v != q:
                scored.append((-float((a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum())), v))
        out += [(q, rank + 1, v, -s) for rank, (s, v) in enumerate(sorted(scored)[:k])]
    return out


def test_recall_on_the_whole_table(spark, small_sf):
    rows = spark.read.parquet(f"{small_sf}/embeddings.parquet").collect()
    found = QUERIES["op2_nearest_neighbours"](spark, small_sf).collect()
    want = plain([r.vec_id for r in rows], [r.embedding for r in rows], [r.vec_id for r in rows if r.vec_id % 50 == 0])
    assert len(found) == len(want)
    scores = {(q, v): s for q, _, v, s in want}
    hits = [(r.query_id, r.vec_id) for r in found if (r.query_id, r.vec_id) in scores]
    assert len(hits) >= 0.9 * len(want)
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-12 for r in found if (r.query_id, r.vec_id) in scores)
    for q in {r.query_id for r in found}:
        mine = sorted((r.rank, -r.score, r.vec_id) for r in found if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
        (9, [None, 1.0]), (10, []), (50, [1.0, 0.0]), (None, [1.0, 0.0]), (100, [1.0, 2.0, 3.0]), (150, [0.0, 0.0]), (11, [1e-300, 1e-300]),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS row", "2 AS key", "3 AS vector", "4 AS rank")
    found = N.nearest(table, F.col("vec_id") % 50 == 0).collect()
    by_query = {q: [(r.vec_id, round(r.score, 12)) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50, 100, 150)}
    tail = [(11, round(2**-0.5, 12)), (3, 0.0)]
    assert by_query[0] == [(1, 1.0), (2, 1.0), (50, 1.0), *tail]
    assert by_query[50] == [(0, 1.0), (1, 1.0), (2, 1.0), *tail]
    assert by_query[100] == [] and by_query[150] == []
    assert N.nearest(table.limit(0), F.lit(True)).collect() == []


def test_few_candidates_are_all_returned(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(4)]
    found = N.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0).collect()
    want = plain([0, 1, 2, 3], [v for _, v in rows], [0])
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [w[:3] for w in want]


def test_a_hot_bucket_is_split_and_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(N, "SPLIT", 10)
    rng = np.random.default_rng(2)
    hot = rng.standard_normal(16)
    vectors = [(hot + 1e-3 * rng.standard_normal(16)).tolist() for _ in range(60)] + [hot.tolist()] * 20 + rng.standard_normal((60, 16)).tolist()
    rows = list(enumerate(vectors))
    found = N.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id").isin(3, 60, 79)).collect()
    want = plain(range(len(rows)), vectors, [3, 60, 79])
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(w[:3] for w in want)


def test_probes_come_in_order_of_success():
    rng = np.random.default_rng(4)
    unit = N._unit(rng.standard_normal((6, 16)))
    few, many = (N.probes(unit, 2, 5, n) for n in (20, 60))
    assert (few == many[:, :, :20]).all()
    near = N.NEAR * unit[:1] + np.sqrt(1 - N.NEAR**2) * N._unit(rng.standard_normal((4000, 16)) - unit[:1] * 0)
    hits = N.buckets(near, 2, 5)
    share = [(hits[:, 0, None] == many[0, 0, a:b]).any(axis=1).mean() for a, b in ((0, 15), (15, 30), (30, 60))]
    assert share[0] > share[1] > share[2] / 2


@pytest.mark.parametrize("count", [1, 5, 40])
def test_probes_are_distinct(count):
    unit = N._unit(np.random.default_rng(6).standard_normal((5, 8)))
    found = N.probes(unit, 3, 4, count)
    assert found.shape == (5, 3, count) and all(len(set(p)) == count for q in found.tolist() for p in q)


def clustered(n, seed=11, centres=40, spread=0.15):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, 32))
    return middle[rng.integers(0, centres, n)] + spread * rng.standard_normal((n, 32))


def test_clustered_vectors_visit_few_rows(spark):
    vectors = clustered(12000, centres=100)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = N.nearest(table, F.col("vec_id") % 400 == 0).collect()
    want = plain(range(12000), vectors, range(0, 12000, 400))
    assert len({(r.query_id, r.vec_id) for r in found} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)
    # The pairs these settings compute: each pair once, and less than a tenth of all.
    unit, many = N._unit(vectors), N.projections_for(12000)
    near = N.typical_nearness(table.select(F.col("embedding").alias("vector")), table.where("vec_id % 400 = 0").selectExpr("vec_id AS query_id", "vec_id AS row", "embedding AS vector"), 5)[32]
    assert near > 0.8
    keys, chance = N.likely_buckets(unit[::400], N.TABLES, many, N.PROBES, near)
    use, rows = N.wanted(chance, N.TABLES), N.buckets(unit, N.TABLES, many)
    order = [np.argsort(c, kind="stable") for c in rows.T]
    met = [N.merged_candidates(order, [c[o] for c, o in zip(rows.T, order)], [k[u] for k, u in zip(own, w)], np.zeros(12000, bool)) for own, w in zip(keys, use)]
    assert all(len(set(m.tolist())) == len(m) for m in met)
    assert sum(map(len, met)) < 0.1 * 12000 * len(met)


def test_probing_stops_when_success_is_enough():
    chance = np.array([[[0.5, 0.2, 0.1, 0.1], [0.05, 0.05, 0.05, 0.05]]])
    assert N.wanted(chance, 2, 0.74).tolist() == [[[True, False, False, False], [True] * 4]]
    assert N.projections_for(100) == 4 and N.projections_for(51_000) == 9 and N.projections_for(10**9) > 15


def test_visits_are_not_broadcast(spark, monkeypatch):
    plans, staged = {}, N.stage

    def spied(df, name):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(N, "stage", spied)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(400, centres=4))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert len(N.nearest(table, F.col("vec_id") % 50 == 0).collect()) == 40
    assert "isFinalPlan=true" in plans["met"] and "Broadcast" not in plans["met"]
    assert re.search(r"SortMergeJoin \[dimension#\d+, table#\d+, key#\d+L?\]", plans["met"])


def test_visits_are_dealt_out_over_blocks(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for q in range(3):
        lists = [(t, rng.choice(700 * N.SPLIT, 900, replace=False).tolist()) for t in (0, 1, 1)]
        rows.append((q, 1, [float(q)], lists))
        for t, places in lists:
            for place in places:
                want.setdefault((q, place // N.SPLIT), ([], [], []))[t].append(place % N.SPLIT)
    visits = spark.createDataFrame(rows, "query_id bigint, dimension int, vector array<double>, visits array<struct<table: int, places: array<bigint>>>")
    found = N._dealt(visits.repartition(1), 3).collect()
    assert len(found) == len(want) > 3 * 512
    assert all(r.vector == [float(r.query_id)] and [sorted(m) for m in r.met] == [sorted(w) for w in want[r.query_id, r.block]] for r in found)
