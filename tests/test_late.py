"""Rows in any order of arrival against one batch."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from signal_lake.operators.dedup import mark_duplicates
from signal_lake.operators.index import StoredIndex
from signal_lake.operators.late import settle
from signal_lake.session import stage
from signal_lake.streaming import ingest_stream as ST

SCHEMA = "arrival bigint, source_id string, external_content_id string, content_hash string"


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_end_in_the_result_of_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), rng.choice([None, *"pqrstu"]), rng.choice("HIJKLMNO")) for i in range(60)]
    whole = stage(spark.createDataFrame(rows, SCHEMA), "whole")
    names = ["inserted", "is_duplicate", "outcome", "reason"]
    shuffled = rng.sample(rows, len(rows))
    root, current, corrections = str(tmp_path / "index"), {}, 0
    for run, start in enumerate(range(0, 60, 20)):
        batch = stage(spark.createDataFrame(shuffled[start : start + 20], SCHEMA), "batch")
        index = StoredIndex(spark, root, tuple(range(run)))
        for r in settle(batch, index).collect():
            # A stored row is only named if its outcome differs.
            now = tuple(r[n] for n in names)
            assert r.fresh == (r.arrival not in current) and current.get(r.arrival) != now
            corrections += not r.fresh
            current[r.arrival] = now
        index.add_members(batch, "arrival", run)
        known = whole.where(F.col("arrival").isin([x[0] for x in shuffled[: start + 20]]))
        want = {r.arrival: tuple(r[n] for n in names) for r in mark_duplicates(known).collect()}
        assert current == want
    assert corrections


def test_a_late_row_opens_its_own_groups_only(spark, tmp_path):
    index = StoredIndex(spark, str(tmp_path / "index"), (0,))
    rows = [(10, "a", "1", "H"), (11, "a", "2", "H"), (12, "b", "1", "J"), (13, "b", None, "J"), (14, "c", "9", "K")]
    index.add_members(spark.createDataFrame(rows, SCHEMA), "arrival", 0)
    late = stage(spark.createDataFrame([(5, "a", "1", "K")], SCHEMA), "late")
    got = {r.arrival: (r.inserted, r.is_duplicate, r.outcome) for r in settle(late, index).collect()}
    # Row 10 loses its key; 11 is the first of H now; 14 comes after the late row. Group J stays closed.
    assert got == {5: (True, False, "saved"), 10: (False, False, "skipped"), 11: (True, False, "saved"), 14: (True, True, "duplicate")}


def test_keys_are_repeated_only_for_the_salts_of_their_members(spark, tmp_path, monkeypatch):
    rows = [(i, "s", None if i % 5 == 0 else str(i % 300), f"h{i % 400}") for i in range(500)]
    index = StoredIndex(spark, str(tmp_path / "index"), (0,))
    index.add_members(spark.createDataFrame(rows[250:], SCHEMA), "arrival", 0)
    plans = {}

    def noted(frame, name):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString()
        return stage(frame, name)

    late = stage(spark.createDataFrame(rows[:250], SCHEMA), "late")
    monkeypatch.setattr("signal_lake.operators.late.stage", noted)
    want = {r.arrival: r.outcome for r in mark_duplicates(stage(spark.createDataFrame(rows, SCHEMA), "whole")).collect()}
    got = {r.arrival: r.outcome for r in settle(late, index).collect()}
    assert all(want[arrival] == outcome for arrival, outcome in got.items()) and set(range(250)) <= set(got)
    assert "Generate" not in plans["known"] and "Range" not in plans["known"]


def test_a_drain_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    root, landing = str(tmp_path / "s"), str(tmp_path / "landing")
    rows = [(i, f"s{i % 2}", str(i % 4), "rss", None, "t", "x" * 200 + str(i % 3), None) for i in range(20)]
    items = spark.createDataFrame(rows, "arrival bigint, source_id string, external_content_id string, fetch_method string, title string, url string, raw_text string, source_language string")
    for part in ("arrival >= 12", "arrival < 5", "arrival >= 5 AND arrival < 12"):
        items.where(part).coalesce(1).write.mode("append").parquet(landing)
        ST.land_fingerprints(spark, landing, items.schema, root)
        with monkeypatch.context() as patch:
            patch.setattr(StoredIndex, "add_members", lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                ST.dedup_landed(spark, root, exact=True)
        ST.land_fingerprints(spark, landing, items.schema, root)
        ST.dedup_landed(spark, root, exact=True)
    from signal_lake.plans import ingest as I

    want = {r.arrival: (r.outcome, r.reason, r.inserted) for r in I.ingest(items).collect()}
    assert {r.arrival: (r.outcome, r.reason, r.inserted) for r in ST.current_outcomes(spark, root).collect()} == want
    assert ST.dedup_landed(spark, root, exact=True).count() == 0
