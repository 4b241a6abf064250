"""The stored side of runs: index, ledger, cursors, trigram counts."""

from __future__ import annotations

import re
import shutil

import pytest
from pyspark.sql import functions as F

from signal_lake.operators import index as X, language as L, tables as T
from signal_lake.operators.dedup import touched_rows
from signal_lake.plans import ingest as I, run as P
from test_runs import BODY, at, landed, make_sources

ROWS = "source_id string, external_content_id string, content_hash string"


def stored_rows(spark, start, stop):
    return spark.range(start, stop).selectExpr(
        "concat('s', id % 7) AS source_id", "IF(id % 5 = 0, NULL, CAST(id AS STRING)) AS external_content_id", "IF(id % 11 = 3, NULL, sha2(CAST(id % 900 AS STRING), 256)) AS content_hash"
    )


def both(pair):
    keys, prints = pair
    return sorted(map(tuple, keys.distinct().collect())), sorted(r[0] for r in prints.distinct().collect())


def test_index_finds_what_a_scan_finds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "FOLDER", 100)
    root = str(tmp_path / "index")
    for run, (start, stop) in enumerate([(0, 700), (600, 1000), (5000, 5001)], 1):
        X.StoredIndex(spark, root, ()).add(stored_rows(spark, start, stop), run)
    index = X.StoredIndex(spark, root, (1, 2, 3))
    whole = stored_rows(spark, 0, 1000).union(stored_rows(spark, 5000, 5001))
    for start, stop in ((500, 1500), (2000, 2100), (5000, 5001), (0, 0)):
        batch = stored_rows(spark, start, stop)
        assert both(index.touched(batch)) == both(touched_rows(batch, whole))
    merged = index.merge(-3)
    assert merged.runs == (-3,) and both(merged.touched(stored_rows(spark, 500, 1500))) == both(touched_rows(stored_rows(spark, 500, 1500), whole))
    assert both(X.StoredIndex(spark, root, (2,)).touched(stored_rows(spark, 0, 500))) == both(touched_rows(stored_rows(spark, 0, 500), stored_rows(spark, 600, 1000)))
    assert both(X.StoredIndex(spark, root, ()).touched(whole)) == ([], [])


def test_a_batch_reads_only_folders_that_may_hold_its_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "FOLDER", 50)
    index = X.StoredIndex(spark, str(tmp_path / "index"), (1,))
    index.add(stored_rows(spark, 0, 3000), 1)
    every = {f for _, f in index.folders_for(X.entries_of(stored_rows(spark, 0, 3000)))}
    assert len(every) > 50
    one = X.entries_of(stored_rows(spark, 17, 18))
    folders = index.folders_for(one)
    assert 1 <= len(folders) <= 4
    files = index.read_folders(folders).inputFiles()
    assert files and {int(re.search(r"folder=(\d+)", f)[1]) for f in files} == {f for _, f in folders}
    # Keys that are not stored rarely pass the filter: hardly any folder is read for them.
    fresh = X.entries_of(spark.range(20).selectExpr("'new' AS source_id", "CAST(id AS STRING) AS external_content_id", "CAST(NULL AS STRING) AS content_hash"))
    assert len(index.folders_for(fresh)) <= 5


def test_index_keeps_what_a_hash_of_keys_would_mix_up(spark, tmp_path, monkeypatch):
    """All places equal: only the keys themselves decide."""
    entries = X.entries_of
    monkeypatch.setattr(X, "entries_of", lambda rows: entries(rows).withColumn("place", F.lit(5).cast("bigint")))
    index = X.StoredIndex(spark, str(tmp_path / "index"), (1,))
    index.add(stored_rows(spark, 0, 40), 1)
    batch = stored_rows(spark, 30, 60)
    assert both(index.touched(batch)) == both(touched_rows(batch, stored_rows(spark, 0, 40)))


def registry(spark):
    sources = make_sources(spark, [("files", "manual_import", "en", 1, None, None), ("talk", "telegram_api", None, 2, None, "@talk"), ("feed", "rss", "de", 3, "https://e.org/feed", None), ("odd", "nope", "en", 1, None, None)])
    return sources.withColumn("fetch_config", F.when(F.col("fetch_method") == "manual_import", '{"file_path": "/d/x.json"}').otherwise("{}"))


def records(spark, first, last):
    manual = landed(spark, [("files", i, str(i), BODY + str(i % 9), None) for i in range(first, last)])["manual_import"]
    talk = spark.range(first, last).selectExpr(
        "'talk' AS canonical_key", "CAST(id AS INT) AS pos", "id + 1 AS msg_id", f"concat('{BODY}', id % 13) AS text", "'@talk' AS channel", "CAST(NULL AS TIMESTAMP) AS date",
        "CAST(NULL AS INT) AS views", "CAST(NULL AS INT) AS replies", "false AS has_media", "CAST(NULL AS BIGINT) AS grouped_id",
    ).withColumn("source_id", T.source_id(F.col("canonical_key")))
    return {"manual_import": manual, "telegram_api": talk}


STEPS = ["write_items", "write_sources", "_finish"]


def state(spark, root):
    items = P.read_items(spark, root)
    return {
        "items": sorted(map(str, items.collect())), "sources": sorted(map(str, P.read_sources(spark, root, 3).collect())),
        "cursors": sorted(map(tuple, P.read_cursors(spark, root).collect())), "ledger": [tuple(r) for r in P.complete_runs(spark, root)],
        "counts": sorted(map(tuple, spark.read.parquet(f"{root}/trigrams/run=2").collect())),
    }


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("first") / "store")
    P.write_sources(registry(spark), root, 1)
    P.run_ingestion(spark, root, P.read_sources(spark, root, 1), records(spark, 0, 12), at("2024-02-01"), version=2, run=1)
    return root


@pytest.fixture(scope="module")
def unbroken(spark, tmp_path_factory, first_run):
    root = shutil.copytree(first_run, str(tmp_path_factory.mktemp("whole") / "store"))
    results = P.run_ingestion(spark, root, P.read_sources(spark, root, 2), records(spark, 5, 20), at("2024-02-02"), version=3, run=2)
    return state(spark, root), sorted(map(tuple, results.collect()))


@pytest.mark.parametrize("step", [*STEPS, "index", "cursors", "results"])
def test_a_run_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch, first_run, unbroken, step):
    root = shutil.copytree(first_run, str(tmp_path / "store"))
    before = sorted(map(str, P.read_items(spark, root).collect()))

    class Broken(Exception):
        pass

    def second():
        return P.run_ingestion(spark, root, P.read_sources(spark, root, 2), records(spark, 5, 20), at("2024-02-02"), version=3, run=2)

    with monkeypatch.context() as patch:
        def breaking(whole):
            def run(*args, **kwargs):
                whole(*args, **kwargs)
                raise Broken
            return run

        def stopped(*args, **kwargs):
            raise Broken

        if step in ("write_items", "write_sources"):
            patch.setattr(P, step, breaking(getattr(P, step)))
        elif step == "_finish":
            patch.setattr(P, step, stopped)
        elif step == "index":
            patch.setattr(X.StoredIndex, "add", breaking(X.StoredIndex.add))
        else:
            writer = type(spark.range(1).write)
            whole = writer.parquet
            patch.setattr(writer, "parquet", lambda self, path, *a, **k: (whole(self, path, *a, **k), stopped())[0] if f"/{step}/run=2" in path else whole(self, path, *a, **k))
        with pytest.raises(Broken):
            second()
    # Nothing of the broken run counts.
    assert sorted(map(str, P.read_items(spark, root).collect())) == before
    results = second()
    want, counters = unbroken
    assert state(spark, root) == want and sorted(map(tuple, results.collect())) == counters
    # Once complete, a run is not done again.
    assert sorted(map(tuple, second().collect())) == counters and state(spark, root) == want


def test_a_version_of_another_run_is_not_overwritten(spark, tmp_path):
    root = str(tmp_path / "store")
    P.write_sources(registry(spark), root, 1)
    with pytest.raises(ValueError, match="version 1"):
        P.run_ingestion(spark, root, P.read_sources(spark, root, 1), records(spark, 0, 2), at("2024-02-01"), version=1)


def test_the_next_run_reads_new_messages_only(spark, tmp_path):
    root = str(tmp_path / "store")
    sources = registry(spark)
    talk = {r.canonical_key: r.id for r in sources.collect()}["talk"]

    def run(first, last, **more):
        only = {"telegram_api": records(spark, first, last)["telegram_api"]}
        return {r.canonical_key: r.fetched for r in P.run_ingestion(spark, root, sources, only, at("2024-02-01"), detect=False, **more).collect()}["talk"]

    assert run(0, 10) == 10
    assert [tuple(r) for r in P.read_cursors(spark, root).collect()] == [(talk, 10)]
    assert run(4, 15) == 5  # messages 11 to 15
    assert run(4, 15, dry_run=True) == 0
    failures = spark.createDataFrame([("talk", "no answer")], "canonical_key string, message string")
    assert run(10, 30, failures=failures) == 0
    assert [tuple(r) for r in P.read_cursors(spark, root).collect()] == [(talk, 15)]
    assert run(10, 30) == 15


def test_indexes_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "MERGE_AFTER", 2)
    root = str(tmp_path / "store")
    sources = registry(spark)
    for k in range(4):
        results = P.run_ingestion(spark, root, sources, {"manual_import": records(spark, 0, 3 + k)["manual_import"]}, at("2024-02-01"), detect=False)
        assert {r.canonical_key: r.saved for r in results.collect()}["files"] == (3 if k == 0 else 1)
    assert [list(r["index_runs"]) for r in P.complete_runs(spark, root)] == [[1], [1, 2], [-3], [-3, 4]]
    assert P.read_items(spark, root).count() == 6


def test_counts_of_parts_add_up(spark):
    rows = spark.createDataFrame([("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("en", "a house"), ("en", None), (None, "x y z")], "lang string, text string")
    parts = [L.count_trigrams(rows.where(c), "text", "lang") for c in ("lang = 'de'", "lang <> 'de' OR lang IS NULL")]
    whole = L.count_trigrams(rows, "text", "lang")
    assert sorted(map(tuple, L.add_counts(*parts).collect())) == sorted(map(tuple, whole.collect()))


def test_wide_rows_meet_one_join(spark, small_sf):
    from signal_lake.plans.views import load
    from signal_lake.session import stage

    items = stage(I.prepared(load(spark, small_sf, "raw_items")), "prepared")
    rows = I.content_rows(items, I.ingest(items), at("2024-02-01"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # The scan that reads raw texts stands under exactly one join, the outermost one.
    wide = [line for line in plan.splitlines() if "raw_text" in line and "Relation" in line]
    assert len([line for line in wide if "Join" in line]) == 0
    depth = next(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if line.lstrip(" :+-").startswith("Join"))
    raw = [line for line in plan.splitlines() if "Project" in line and "raw_text" in line and len(line) - len(line.lstrip(" :+-")) > depth]
    assert len(raw) == 1


def test_changes_leave_untouched_files_in_place(spark, tmp_path):
    from pathlib import Path

    from signal_lake.operators import stored_changes as C

    path = str(tmp_path / "items")
    rows = spark.range(400).selectExpr("id", "concat('s', id % 20) AS source_id", "'new' AS status").withColumn("bucket", C.source_bucket(8))
    rows.write.partitionBy("bucket").parquet(path)
    files = {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in Path(path).rglob("*.parquet")}
    bucket = {r.source_id: r.bucket for r in rows.collect()}

    def stored():
        return spark.read.schema("id bigint, source_id string, status string, bucket int").parquet(path)

    def untouched(changed):
        left = {p for p in files if not any(f"bucket={b}/" in str(p) for b in changed)}
        assert left and all(p.exists() and (p.stat().st_mtime_ns, p.read_bytes()) == files[p] for p in left)

    gone = spark.createDataFrame([("s3",), ("nobody",)], "source_id string")
    assert [r.bucket for r in C.delete_sources(stored(), path, ["bucket"], gone, "id").collect()] == [bucket["s3"]]
    untouched({bucket["s3"]})
    changes = spark.createDataFrame([(7, "selected", 1), (7, "drafted", 2), (5000, "drafted", 1)], "id bigint, status string, seq bigint")
    for _ in range(2):
        C.set_statuses(stored(), path, ["bucket"], changes)
        untouched({bucket["s3"], bucket["s7"]})
        assert {(r.id, r.source_id, r.status) for r in stored().collect()} == {(i, f"s{i % 20}", "drafted" if i == 7 else "new") for i in range(400) if i % 20 != 3}
    # All sources of a partition: the partition goes.
    whole = [s for s, b in bucket.items() if b == bucket["s7"]]
    C.delete_sources(stored(), path, ["bucket"], spark.createDataFrame([(s,) for s in whole], "source_id string"), "id")
    assert {r.source_id for r in stored().collect()} == set(bucket) - {*whole, "s3"}
    assert C.delete_sources(stored(), path, ["bucket"], gone, "id").count() == 0


def test_a_trigram_is_no_row_of_its_own(spark):
    rows = spark.createDataFrame([(1, "de", "İstanbul ΣΑΣ 😀😀😀 und noch mehr"), (2, "en", "ab"), (3, None, "noch mehr und noch mehr Worte"), (4, None, "qqqqqqqqqqqqqqqqqqqqqqqq")], "id int, lang string, text string")
    counts = L.count_trigrams(rows, "text", "lang")
    lowered = rows.where("id = 1").select(F.lower("text")).first()[0]
    assert counts.agg(F.sum("n")).first()[0] == len(lowered) - 2
    found = L.detect(rows, "id", "text", L.profile_of(counts))
    for frame in (counts, found):
        assert "Generate" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.id, r.detected) for r in found.collect()} == {(1, "de"), (3, "de")}
