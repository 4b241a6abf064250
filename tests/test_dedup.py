from __future__ import annotations

from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from signal_lake.operators.dedup import mark_duplicates, touched_rows
from signal_lake.operators.skew import first_n, keep_first, large_lookup_join, lookup_join, with_previous
from signal_lake.plans import run as P

SCHEMA = "arrival bigint, source_id string, external_content_id string, content_hash string"
STORED = "source_id string, external_content_id string, content_hash string"


def one_by_one(items, stored):
    """The run item by item: probe the hash, then try to insert."""
    keys = {(s, e) for s, e, _ in stored if e is not None}
    hashes = {h for _, _, h in stored}
    seen = {}
    for arrival, source, ext, print_ in sorted(items):
        duplicate = print_ in hashes
        inserted = ext is None or (source, ext) not in keys
        if inserted:
            keys.add((source, ext))
            hashes.add(print_)
        seen[arrival] = ("duplicate" if duplicate else "saved" if inserted else "skipped", inserted, duplicate)
    return seen


item = st.tuples(st.sampled_from("ab"), st.sampled_from([None, "1", "2", "3"]), st.sampled_from("xyz"))


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(item, max_size=40), st.lists(item, max_size=4))
def test_same_as_one_by_one(spark, rows, stored):
    items = [(i, *r) for i, r in enumerate(rows)]
    frame, kept = spark.createDataFrame(items, SCHEMA), spark.createDataFrame(stored, STORED)
    # The store as it is, and cut down to what the batch can meet.
    known = (kept.select("source_id", "external_content_id"), kept.select("content_hash"))
    marked = mark_duplicates(frame, stored=known if len(rows) % 2 else touched_rows(frame, kept), salts=3)
    got = {r.arrival: (r.outcome, r.inserted, r.is_duplicate) for r in marked.collect()}
    assert got == one_by_one(items, stored)


def test_without_a_store_and_with_hot_groups(spark):
    items = [(i, "a", str(i % 5) if i % 3 else None, "hot" if i % 2 else f"h{i % 50}") for i in range(600)]
    got = {r.arrival: (r.outcome, r.inserted, r.is_duplicate) for r in mark_duplicates(spark.createDataFrame(items, SCHEMA)).collect()}
    assert got == one_by_one(items, [])


def test_swallowed_item_leaves_no_fingerprint(spark):
    items = [(0, "a", "1", "x"), (1, "a", "1", "y"), (2, "a", "2", "y"), (3, "a", "2", "y")]
    got = {r.arrival: (r.outcome, r.reason) for r in mark_duplicates(spark.createDataFrame(items, SCHEMA)).collect()}
    assert got == {0: ("saved", None), 1: ("skipped", "key_conflict"), 2: ("saved", None), 3: ("duplicate", None)}


def test_order_may_be_a_struct(spark):
    frame = spark.createDataFrame([(2, 1, "a", None, "x"), (1, 9, "b", None, "x")], "t int, p int, source_id string, external_content_id string, content_hash string")
    frame = frame.select(F.struct("t", "p").alias("arrival"), "source_id", "external_content_id", "content_hash")
    got = {r.source_id: r.outcome for r in mark_duplicates(frame).collect()}
    assert got == {"a": "duplicate", "b": "saved"}


def test_first_n_and_keep_first(spark):
    frame = spark.createDataFrame([(k, i) for i in range(50) for k in "ab"], "k string, i int")
    assert sorted(map(tuple, first_n(frame, ["k"], [F.col("i").desc()], 2, 2).collect())) == [("a", 48), ("a", 49), ("b", 48), ("b", 49)]
    limit = F.when(F.col("k") == "a", 1).otherwise(3)
    assert first_n(frame, ["k"], [F.col("i")], limit, 3).groupBy("k").count().orderBy("k").collect() == [("a", 1), ("b", 3)]
    assert sorted(map(tuple, keep_first(frame, ["k"], "i").collect())) == [("a", 0), ("b", 0)]


def test_first_n_with_a_large_bound(spark):
    frame = spark.range(6000).withColumn("k", F.when(F.col("id") < 5000, "hot").otherwise("cold"))
    kept = first_n(frame, ["k"], [F.col("id").desc()], 1500, 1500)
    got = {r.k: (r.n, r.low) for r in kept.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low")).collect()}
    assert got == {"hot": (1500, 3500), "cold": (1000, 5000)}


def test_first_n_cuts_before_the_shuffle(spark):
    frame = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, "hot").otherwise("cold"))
    plan = first_n(frame, ["k"], [F.col("id")], 5, 5)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 5, Partial")
    assert plan.index("Exchange hashpartitioning(k") < partial


def test_lookup_join_hits_every_row_once(spark):
    rows = spark.range(500).withColumn("k", F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")))
    table = spark.createDataFrame([("hot", 1), ("450", 2)], "k string, v int")
    assert lookup_join(rows, table, "k", "id").groupBy("v").count().orderBy("v").collect() == [(None, 99), (1, 400), (2, 1)]
    assert lookup_join(rows, table, "k", "id", "left_anti").count() == 99


def test_a_lookup_table_is_broadcast_only_if_all_its_repeats_are_small(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3000).alias("k"))
    table = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "100k")  # the table is smaller, 16 of it are not
        large, small = lookup_join(rows, table, "k", "id"), lookup_join(rows, table.where("k < 10").limit(10), "k", "id")
        assert large.where("v = 2 * k").count() == 5000 and small.where("v IS NOT NULL").count() == 20
        for found, hashed in ((large, False), (small, True)):
            found.collect()
            assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == hashed
    finally:
        spark.conf.set(name, before)


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.sampled_from(["x", "y", None])), max_size=30, unique_by=lambda r: r[:2]))
def test_previous_across_blocks(spark, rows):
    frame = spark.createDataFrame(rows, "k string, o int, v string")
    got = {(r.k, r.o): r.p for r in with_previous(frame, ["k"], "o", "v", "p", F.floor(F.col("o") / 7)).collect()}
    want = {}
    for key in "ab":
        mine = sorted(r for r in rows if r[0] == key)
        for before, row in zip([None, *mine], mine):
            want[key, row[1]] = before[2] if before else None
    assert got == want


def test_large_tables_are_repeated_only_for_the_salts_that_occur(spark):
    rows = spark.range(500).selectExpr("id", "CASE WHEN id < 400 THEN 'hot' WHEN id < 402 THEN 'k' ELSE NULL END AS k")
    table = spark.createDataFrame([("hot", 1), ("k", 2), ("never asked", 3)], "k string, v int")
    found = large_lookup_join(rows, table, "k", "id")
    assert found.groupBy("v").count().orderBy("v").collect() == [(1, 400), (2, 2)]
    assert large_lookup_join(rows, table, "k", "id", "left").count() == 500
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    sources = spark.createDataFrame([("a", 0, "en", "rss")], "id string, place bigint, language string, fetch_method string")
    items = spark.createDataFrame([("a", 7, "rss")], "source_id string, pos bigint, fetch_method string")
    ordered = P.ordered_items(items, sources)
    assert ordered.select("arrival", "source_language").collect() == [(7, "en")]
    assert "Generate" not in ordered._jdf.queryExecution().optimizedPlan().toString()
