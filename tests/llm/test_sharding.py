"""Shards of even size that keep equal texts together."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from signal_lake.llm import sharding as H
from signal_lake.llm.catalog import QUERIES


def check(rows, shards=16):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(sizes) <= set(range(shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_whole_table(spark, small_sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    rows = QUERIES["op4_sharding"](spark, small_sf).collect()
    check(rows)
    assert {r.doc_id for r in rows} == set(docs)
    together = defaultdict(set)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        together[docs[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in together.values())


def test_a_group_of_a_third_fills_the_fewest_shards(spark):
    texts = ["hot"] * 200 + [f"t{i // 3}" for i in range(300)] + [f"s{i}" for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = H.shard_documents(docs).collect()
    check(rows)
    shards = defaultdict(Counter)
    for r in rows:
        shards[texts[r.doc_id]][r.shard] += 1
    assert sum(n for _, n in shards["hot"].most_common(5)) == 5 * 37  # 200 rows are 5 full shards and a rest
    assert sum(len(s) > 1 for t, s in shards.items() if t.startswith("t")) <= 25


def test_odd_documents(spark, odd_docs, no_docs):
    rows = H.shard_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check(rows)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[2].size, by_id[2].text_crc32) == (1, 0) and by_id[None].size == 25
    two = {r.doc_id: r for r in H.shard_documents(odd_docs, shards=2).collect()}
    assert two[1].shard == two[11].shard and two[2].shard == two[3].shard
    assert H.shard_documents(no_docs).collect() == []
    few = H.shard_documents(odd_docs.where("doc_id IN (1, 3)"), shards=4).collect()
    check(few, 4)


def test_groups_below_half_a_shard_stay_whole(spark):
    texts = [f"g{i // 90}" for i in range(16 * 90)] + [f"s{i}" for i in range(16 * 110)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = H.shard_documents(docs).collect()
    check(rows)
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id]].add(r.shard)
    assert max(map(len, shards.values())) == 1


def plain_cut(rows, units, settled, shards):
    """Cut edges when settled units are where they settled and all other rows where they start."""
    where = defaultdict(Counter)
    for row, start in rows.items():
        where[units[row]][settled.get(units[row], start)] += 1
    return sum((sum(c.values()) ** 2 - sum(n * n for n in c.values())) // 2 for c in where.values())


def test_propagation_brings_scattered_groups_together(spark):
    links = spark.createDataFrame([(i, i // 90) for i in range(16 * 90)], "row bigint, link bigint")
    own, spread, sizes = H.units_of(links, 16)
    settled, room, cuts = H.propagate(spread, sizes, np.full(16, 200))
    found = {r.unit: r.shard for r in settled.collect()}
    assert sorted(found) == list(range(16)) and (room >= 0).all() and room.sum() == 16 * 110
    assert Counter(found.values()) == {s: int(200 - r) // 90 for s, r in enumerate(room) if r < 200}
    rows = {r.row: r.shard for r in links.select("row", H.start_of().alias("shard")).collect()}
    units = {r.row: r.unit for r in own.collect()}
    assert cuts[0] == plain_cut(rows, units, {}, 16) > 0 and cuts[-1] == 0
    assert all(b < a for a, b in zip(cuts, cuts[1:], strict=False))


def test_propagation_moves_rows_of_documents(spark, small_sf):
    """The rounds do the work on the given table: equal texts start apart and end together, with fewer cut edges after every round."""
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select(F.col("doc_id").alias("row"), "text")
    first = docs.groupBy("text").agg(F.count("*").alias("n"), F.min("row").alias("link")).where("n > 1")
    links = docs.join(first, "text").select("row", "link")
    own, spread, sizes = H.units_of(links, 16)
    settled, _, cuts = H.propagate(spread, sizes, np.full(16, docs.count() // 16))
    rows = {r.row: r.shard for r in links.select("row", H.start_of().alias("shard")).collect()}
    units = {r.row: r.unit for r in own.collect()}
    found = {r.unit: r.shard for r in settled.collect()}
    assert cuts[0] == plain_cut(rows, units, {}, 16) and cuts[-1] == plain_cut(rows, units, found, 16) == 0
    assert len(cuts) > 1 and all(b < a for a, b in zip(cuts, cuts[1:], strict=False))
    assert sum(found[units[row]] != start for row, start in rows.items()) > len(rows) // 2


def test_wishes_go_to_most_neighbours_with_room(spark):
    spread = spark.createDataFrame([(1, 1, 0, 5), (1, 1, 1, 3), (2, 2, 0, 4), (2, 2, 2, 1), (3, 3, 1, 2), (3, 3, 2, 2)], "unit bigint, link bigint, shard int, w bigint")
    sizes = spark.createDataFrame([(1, 8), (2, 5), (3, 4)], "unit bigint, size bigint")
    granted = {r.unit: r.target for r in H._round(spread, sizes, np.array([8, 4, 5]), 8).collect()}
    assert granted[3] in (1, 2) and list(granted.values()).count(0) == 1  # units 1 and 2 both wish for shard 0, which has room for one
    settled, room, cuts = H.propagate(spread, sizes, np.array([8, 4, 5]))
    assert {r.unit: r.shard for r in settled.collect()} == {1: 0, 2: 2, 3: 1} and room.tolist() == [0, 0, 0] and cuts[-1] == 0


def test_few_groups_are_split_if_all_rows_are_linked(spark):
    texts = [f"g{i // 130}" for i in range(16 * 130)] + [f"t{i // 7}" for i in range(16 * 70)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = H.shard_documents(docs).collect()
    check(rows)
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 16 and all(len(s) == 1 for t, s in shards.items() if t[0] == "g")


def test_links_that_share_rows_end(spark):
    links = spark.createDataFrame([(i, i // 3) for i in range(300)] + [(i, 1000 + i // 10) for i in range(0, 300, 2)], "row bigint, link bigint")
    rows = H.shard_rows(spark.range(300).withColumnRenamed("id", "row"), links, 4).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [75] * 4
