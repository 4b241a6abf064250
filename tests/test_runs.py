from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from signal_lake.operators import language as L, tables as T
from signal_lake.operators.skew import global_rank
from signal_lake.plans import ingest as I, registry as G, run as P
from signal_lake.plans.limits import pick_landed
from signal_lake.plans.views import load
from signal_lake.schemas import CONTENT_ITEMS, SOURCE_SEED, SOURCES
from signal_lake.session import stage, staged_scope
from signal_lake.sources.router import route
from signal_lake.streaming import ingest_stream as ST



def at(text):
    return F.lit(f"{text}T00:00:00Z").cast("timestamp")


HEADER = "source_name,type,primary_platform,secondary_platforms,url_or_handle,themes,signal_type,signal_quality,early_signal_potential,startup_signal_value,content_adaptation_value,brand_fit,tier,monitoring_frequency,region,why_relevant\n"


def write_list(tmp_path, *lines):
    path = tmp_path / "list.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_registry_from_csv_to_both_sinks_and_back(spark, tmp_path):
    path = write_list(
        tmp_path,
        'Анна Ли,person,TG,"YT, LI;TG",@anna,a; b ;,sig,5,4.9,x,,0,1,2-3x_week,RU/mixed,"why, ""so"""',
        " ,person,TG,,@none,,,,,,,,,,,",
        "Ilya Krasinsky,person,TG,,@i,,,,,,,,,,,",
        "Анна  ЛИ!,media,WEB,,e.org,,,,,,,,2,,,",
        "Blog,,WEB,,trending,,,,,,,,,,EN/global,",
    )
    seeds = G.transform_registry(G.read_registry_csv(spark, path))
    rows = {r.canonical_key: r for r in seeds.collect()}
    assert sorted(rows) == ["anna-li", "blog"]
    anna, blog = rows["anna-li"], rows["blog"]
    assert (anna.source_name, anna.platforms, anna.themes, anna.language) == ("Анна Ли", ["TG", "YT", "LI"], ["a", "b"], "mixed")
    assert (anna.signal_quality, anna.early_signal_potential, anna.startup_signal_value, anna.brand_fit, anna.tier) == (5, 4, None, 0, 1)
    assert (anna.monitoring_frequency, anna.notes, anna.fetch_method, anna.wave) == ("3x_week", 'why, "so"', "telegram_api", 1)
    assert (blog.source_type, blog.url, blog.handle, blog.fetch_method, blog.tier, blog.region) == ("unknown", None, "trending", "rss", 3, "EN/global")
    G.write_seed(seeds, str(tmp_path / "json"), str(tmp_path / "csv"))
    back = G.read_seed(spark, str(tmp_path / "json"))
    assert back.schema == SOURCE_SEED
    columns = SOURCE_SEED.names
    assert sorted(map(str, back.select(*columns).collect())) == sorted(map(str, seeds.select(*columns).collect()))
    flat = {r.canonical_key: r for r in spark.read.csv(str(tmp_path / "csv"), header=True, escape='"').collect()}
    assert (flat["anna-li"].platforms, flat["anna-li"].themes, flat["anna-li"].fetch_config, flat["anna-li"].notes) == ("TG;YT;LI", "a;b", "{}", 'why, "so"')


def test_decoded_config(spark):
    frame = spark.createDataFrame([('["TG"]', '{"limit": 5, "languages": ["ru"], "other": 1}')], "platforms string, fetch_config string")
    row = G.decode_config(frame).first()
    assert row.platforms == ["TG"] and row.fetch_config.limit == 5 and row.fetch_config.languages == ["ru"]


def make_sources(spark, rows):
    """Rows (key, method, language, tier, url, handle) as stored sources."""
    seed = spark.createDataFrame(
        rows, "canonical_key string, fetch_method string, language string, tier smallint, url string, handle string"
    )
    seed = seed.selectExpr(
        "*", "canonical_key AS source_name", "canonical_key AS canonical_name", "'media' AS source_type", "CAST(NULL AS STRING) AS region",
        "CAST(NULL AS STRING) AS primary_platform", "CAST(array() AS ARRAY<STRING>) AS platforms", "CAST(array() AS ARRAY<STRING>) AS themes",
        "CAST(NULL AS STRING) AS signal_type", *[f"CAST(NULL AS SMALLINT) AS {n}" for n in SOURCE_SEED.names if n.endswith(("quality", "potential", "value", "fit"))],
        "CAST(1 AS SMALLINT) AS wave", "CAST(NULL AS STRING) AS monitoring_frequency", "'{}' AS fetch_config", "true AS is_active", "CAST(NULL AS STRING) AS notes",
    )
    return T.new_sources(seed, at("2024-01-01"))


BODY = "A long enough text about something that happened today. " * 4


def landed(spark, rows):
    """Rows (key, pos, id, text, url) as manual records."""
    frame = spark.createDataFrame(rows, "canonical_key string, pos int, id string, text string, url string")
    return {"manual_import": frame.withColumn("source_id", T.source_id(F.col("canonical_key")))}


def test_run_against_a_store(spark, tmp_path):
    root = str(tmp_path / "store")
    sources = make_sources(spark, [
        ("late", "manual_import", "en", 2, None, None), ("early", "manual_import", None, 1, None, None), ("idle", "manual_import", "en", 3, None, None),
        ("broken", "rss", "en", 1, None, None), ("odd", "nope", "en", 1, None, None),
    ]).withColumn("fetch_config", F.when(F.col("fetch_method") == "manual_import", '{"file_path": "/d/x.json"}').otherwise("{}"))
    P.write_sources(sources, root, 1)
    sources = P.read_sources(spark, root, 1)
    records = landed(spark, [
        ("late", 0, "1", BODY, "https://e.org/x"), ("late", 1, "1", BODY + "other", None), ("late", 2, None, "short", None),
        ("early", 0, "1", BODY, " HTTPS://E.org/x"), ("early", 1, None, BODY + "two", None), ("gone", 0, "1", BODY, None),
    ])
    dry = P.run_ingestion(spark, root, sources, records, at("2024-02-01"), version=2, dry_run=True)
    assert not os.path.exists(f"{root}/content_items") and not os.path.exists(f"{root}/sources/version=2")
    results = P.run_ingestion(spark, root, sources, records, at("2024-02-01"), version=2)
    assert sorted(map(tuple, dry.collect())) == sorted(map(tuple, results.collect()))
    got = {r.canonical_key: (r.fetched, r.saved, r.duplicates, r.skipped, r.errors, r.success) for r in results.collect()}
    assert got == {
        "early": (2, 2, 0, 0, 0, True), "late": (3, 0, 1, 2, 0, True), "idle": (0, 0, 0, 0, 0, True),
        "broken": (0, 0, 0, 0, 1, False), "odd": (0, 0, 0, 0, 1, False),
    }
    assert tuple(I.run_summary(results).first()) == (5, 5, 2, 1, 2, 2)
    stored = P.read_items(spark, root)
    assert stored.schema == CONTENT_ITEMS
    assert {(r.external_content_id, r.is_duplicate, r.status, r.language, r.content_type) for r in stored.collect()} == {
        ("1", False, "deduplicated", "en", "article"), (None, False, "deduplicated", "en", "article"), ("1", True, "deduplicated", "en", "article"),
    }
    after = {r.canonical_key: r for r in P.read_sources(spark, root, 2).collect()}
    assert (after["broken"].error_count, after["broken"].last_error_msg, after["broken"].last_checked_at) == (1, "no feed address", None)
    assert (after["odd"].error_count, after["odd"].last_checked_at) == (0, None)
    assert after["idle"].last_checked_at is not None and after["idle"].updated_at > after["idle"].created_at

    again = P.run_ingestion(spark, root, P.read_sources(spark, root, 2), records, at("2024-02-01"))
    assert sum(r.saved for r in again.collect()) == 0
    # An item without an external id goes in again, flagged; nothing else does.
    assert P.read_items(spark, root).count() == 4
    only = P.run_ingestion(spark, str(tmp_path / "other"), sources, records, at("2024-02-01"), key="late")
    assert {r.canonical_key: r.saved for r in only.collect()} == {"late": 1}


def test_runs_that_name_no_source_or_bring_nothing(spark, tmp_path):
    sources = make_sources(spark, [("a", "manual_import", "en", 1, None, None), ("b", "nope", "en", 1, None, None), ("c", "manual_import", "en", 1, None, None)])
    sources = sources.withColumn("fetch_config", F.lit('{"file_path": "/d/x.json"}')).withColumn("is_active", F.col("canonical_key") != "c")
    root, records = str(tmp_path / "store"), landed(spark, [("a", 0, "1", BODY, None)])
    for key, problem in (("gone", "no source has the key 'gone'"), ("c", "source 'c' is not active")):
        with pytest.raises(ValueError, match=problem):
            P.run_ingestion(spark, root, sources, records, at("2024-02-01"), key=key)
    for nothing in ({}, {"nope": records["manual_import"]}):
        results = P.run_ingestion(spark, root, sources, nothing, at("2024-02-01"), dry_run=True)
        assert {r.canonical_key: (r.fetched, r.errors) for r in results.collect()} == {"a": (0, 0), "b": (0, 1)}
    failures = spark.createDataFrame([("a", "feed parse error"), ("a", "feed parse error"), ("gone", "x")], "canonical_key string, message string")
    results = P.run_ingestion(spark, root, sources, records, at("2024-02-01"), version=2, failures=failures)
    assert {r.canonical_key: (r.fetched, r.errors) for r in results.collect()} == {"a": (0, 1), "b": (0, 1)}
    assert {r.canonical_key: r.last_error_msg for r in P.read_sources(spark, root, 2).collect()} == {"a": "feed parse error", "b": None, "c": None}


def test_short_years_go_by_the_time_of_the_run(spark, tmp_path):
    sources = make_sources(spark, [("a", "manual_import", "en", 1, None, None)]).withColumn("fetch_config", F.lit('{"file_path": "/d/x.json"}'))
    records = landed(spark, [("a", 0, "1", BODY, None)])
    records = {"manual_import": records["manual_import"].withColumn("date", F.lit("05 Jan 75")).drop("published_at")}
    for year in (2020, 2060):
        root = str(tmp_path / str(year))
        P.run_ingestion(spark, root, sources, records, at(f"{year}-02-01"), version=2)
        assert [r.published_at.year for r in P.read_items(spark, root).collect()] == [1975 if year == 2020 else 2075]


def test_sources_set_their_limits(spark):
    sources = make_sources(spark, [("a", "telegram_api", "en", 1, None, "@a"), ("b", "telegram_api", "en", 1, None, "@b"), ("h", "hn_api", "en", 1, None, None), ("w", "web_scraper", "en", 1, None, None)])
    config = F.create_map(F.lit("a"), F.lit('{"limit": 2, "min_id": 3}'), F.lit("b"), F.lit("{}"), F.lit("h"), F.lit('{"feed": "askhn", "limit": 3, "min_score": 2}'), F.lit("w"), F.lit('{"content_selector": ".x.y", "title_selector": "h1"}'))
    sources = sources.withColumn("fetch_config", F.try_element_at(config, F.col("canonical_key")))
    ids = {r.canonical_key: r.id for r in sources.collect()}
    messages = spark.createDataFrame(
        [(ids["a"], i, i, "" if i == 7 else f"m{i}") for i in range(1, 8)] + [(ids["b"], i, i, "t") for i in range(1, 61)] + [("other", 1, 1, "t")],
        "source_id string, pos int, msg_id bigint, text string",
    )
    kept = pick_landed("telegram_api", messages, sources)
    assert kept.columns == messages.columns
    assert sorted(r.msg_id for r in kept.where(F.col("source_id") == ids["a"]).collect()) == [6]
    assert kept.where(F.col("source_id") == ids["b"]).agg(F.min("msg_id"), F.count("*")).first() == (11, 50)
    stories = spark.createDataFrame(
        [(ids["h"], i, title, score) for i, (title, score) in enumerate([("Ask HN: a", 5), ("Ask HN: b", 1), ("Show HN: c", 9), ("Ask HN: late", 9)])],
        "source_id string, pos int, title string, score int",
    ).selectExpr("*", "false AS deleted", "CAST(NULL AS BOOLEAN) AS dead")
    assert [r.title for r in pick_landed("hn_api", stories, sources).collect()] == ["Ask HN: a"]
    pages = spark.createDataFrame([(ids["w"], 0, "u", "<title>t</title><h1>Head</h1><p class='x.y'>chosen</p><main>m</main>")], "source_id string, pos int, url string, html string")
    items = route({"web_scraper": pick_landed("web_scraper", pages, sources)}, ["source_id", "pos"]).collect()
    assert [(r.title, r.raw_text) for r in items] == [("Head", "chosen")]


def test_sources_set_their_listings_and_videos(spark):
    sources = make_sources(spark, [("m", "huggingface_api", "en", 1, None, None), ("p", "huggingface_api", "en", 1, None, None), ("v", "youtube_transcript", "en", 1, None, None)])
    config = F.create_map(F.lit("m"), F.lit('{"feed": "trending_models", "sort": "downloads", "limit": 1}'), F.lit("p"), F.lit('{"limit": 1}'), F.lit("v"), F.lit('{"video_ids": ["a", "b"], "languages": ["de"]}'))
    sources = sources.withColumn("fetch_config", F.try_element_at(config, F.col("canonical_key")))
    ids = {r.canonical_key: r.id for r in sources.collect()}
    listing = spark.createDataFrame(
        [(ids["m"], i, f'{{"id": "m{i}", "likes": {9 - i}, "downloads": {i}}}') for i in range(3)] + [(ids["p"], i, f'{{"paper": {{"id": "p{i}"}}}}') for i in range(3)],
        "source_id string, pos int, json string",
    )
    items = route({"huggingface_api": pick_landed("huggingface_api", listing, sources)}, ["source_id", "pos"]).collect()
    assert {(r.external_content_id, r.source_content_type) for r in items} == {("m2", "hf_model"), ("p0", "hf_paper")}
    videos = spark.createDataFrame(
        [(ids["v"], i, v, lang, False, "t") for i, (v, lang) in enumerate([("a", "en"), ("a", "de"), ("b", "en"), ("c", "de")])],
        "source_id string, pos int, video_id string, lang string, is_generated boolean, text string",
    )
    assert {(r.video_id, r.lang) for r in pick_landed("youtube_transcript", videos, sources).collect()} == {("a", "de"), ("b", "en")}


def test_registry_list_goes_by_name(spark, tmp_path):
    (tmp_path / "list.csv").write_text("type,source_name,tier\nmedia,One,2\nmedia,Two,9\n", encoding="utf-8")
    rows = G.read_registry_csv(spark, str(tmp_path / "list.csv"))
    seed = {r.canonical_key: (r.source_type, r.tier) for r in G.transform_registry(rows).collect()}
    assert seed == {"one": ("media", 2), "two": ("media", 9)}
    stored = make_sources(spark, [("one", "rss", "en", 1, None, None)])
    merged, bad = G.load_registry(rows, stored, at("2024-02-01"))
    assert {r.canonical_key: r.tier for r in merged.collect()} == {"one": 2} and bad.first().violations == ["tier_range"]
    (tmp_path / "odd.csv").write_text("name,tier\nOne,2\n", encoding="utf-8")
    with pytest.raises(ValueError):
        G.read_registry_csv(spark, str(tmp_path / "odd.csv"))


def test_places_over_a_whole_table(spark):
    rows = spark.range(5000).selectExpr("id", "hash(id) % 97 AS h")
    got = global_rank(rows, [F.desc("h"), "id"], "place").orderBy("place").collect()
    assert [r.place for r in got] == list(range(5000)) and [r.id for r in got] == [r.id for r in rows.orderBy(F.desc("h"), "id").collect()]


def test_late_files_get_outcomes(spark, tmp_path):
    root, landing = str(tmp_path / "s"), str(tmp_path / "landing")
    rows = [(i, f"s{i % 2}", str(i % 4), "rss", None, "t", "x" * 200 + str(i % 3), None) for i in range(20)]
    items = spark.createDataFrame(rows, "arrival bigint, source_id string, external_content_id string, fetch_method string, title string, url string, raw_text string, source_language string")
    for part in ("arrival >= 10", "arrival < 10", "arrival < 0"):
        items.where(part).coalesce(1).write.mode("append").parquet(landing)
        ST.land_fingerprints(spark, landing, items.schema, root)
        ST.dedup_landed(spark, root)
    assert sorted(r.arrival for r in ST.all_outcomes(spark, root).collect()) == list(range(20))


def test_staged_tables_go_with_their_scope(spark, tmp_path):
    outside = stage(spark.range(3), "kept")
    with staged_scope(spark) as paths:
        rows = stage(spark.range(5), "gone")
        rows.write.parquet(str(tmp_path / "result"))
        assert os.path.exists(paths[0])
    assert not os.path.exists(paths[0]) and outside.count() == 3 and spark.read.parquet(str(tmp_path / "result")).count() == 5


def test_language_is_filled_in(spark):
    words = {"en": "the cat and the dog are in the house with another animal ", "de": "der hund und die katze sind in dem haus mit einem tier "}
    items = spark.createDataFrame(
        [(i, words["en" if i % 2 else "de"] * (1 + i % 3), ["", None, "mixed"][i % 3]) for i in range(12)] + [(99, "the", None)],
        "arrival bigint, normalized_text string, source_language string",
    )
    profile = L.train_profile(spark.createDataFrame(list(words.items()), "lang string, text string"), "text", "lang")
    got = {r.arrival: r.language for r in I.fill_language(items, "arrival", profile).collect()}
    assert got == {i: "mixed" if i % 3 == 2 else "en" if i % 2 else "de" for i in range(12)} | {99: None}


def test_language_of_unseen_texts(spark, small_sf):
    docs = load(spark, small_sf, "documents").where(F.length("text") >= 100)
    profile = L.train_profile(docs.where(F.col("doc_id") % 2 == 0), "text", "lang")
    unseen = docs.where(F.col("doc_id") % 2 == 1)
    found = unseen.join(L.detect(unseen, "doc_id", "text", profile), "doc_id", "left")
    assert found.where(F.col("lang") == F.col("detected")).count() >= 0.98 * unseen.count()


def test_upsert_keeps_state(spark):
    old = make_sources(spark, [("a", "rss", "en", 1, "u", None), ("b", "rss", "en", 1, "u", None)])
    old = old.withColumn("error_count", F.lit(4)).withColumn("is_active", F.lit(False))
    new = make_sources(spark, [("b", "rss", "ru", 3, None, None), ("c", "rss", "en", 2, "u", None)])
    got = {r.canonical_key: r for r in T.upsert_sources(old, new.select(*SOURCE_SEED.names), at("2024-02-01")).collect()}
    assert sorted(got) == ["a", "b", "c"] and got["b"].__fields__ == SOURCES.names
    b = got["b"]
    assert (b.language, b.tier, b.url, b.is_active, b.error_count) == ("ru", 3, None, True, 4)
    assert b.created_at < b.updated_at and got["a"].created_at == got["a"].updated_at and got["c"].error_count == 0
    assert got["a"].is_active is False


def test_constraints(spark):
    rows = make_sources(spark, [("ok", "rss", "en", 3, None, None), ("bad", "weird", "en", 9, None, None)])
    rows = rows.withColumn("brand_fit", F.when(F.col("canonical_key") == "bad", 0).cast("smallint"))
    good, bad = T.split_quarantine(rows)
    assert [r.canonical_key for r in good.collect()] == ["ok"]
    assert bad.first().violations == ["brand_fit_range", "tier_range", "fetch_method_unknown"]
    items = spark.createDataFrame([("s", None, "odd"), ("s", "h", "new")], "source_id string, content_hash string, status string")
    assert [r[0] for r in items.select(T.item_violations()).collect()] == [["content_hash_missing", "status_unknown"], []]


def test_selection(spark):
    sources = make_sources(spark, [("b", "rss", "en", 2, None, None), ("a", "rss", "en", 2, None, None), ("c", "hn_api", "en", 1, None, None)])
    sources = sources.withColumn("wave", F.when(F.col("canonical_key") == "c", 2).otherwise(1))
    assert [r.canonical_key for r in P.select_sources(sources).orderBy(*G.processing_order()).collect()] == ["c", "a", "b"]
    assert [r.canonical_key for r in P.select_sources(sources, method="hn_api").collect()] == ["c"]
    assert P.select_sources(sources, wave=1).count() == 2 and P.select_sources(sources, key="a").count() == 1
    off = sources.withColumn("is_active", F.lit(False))
    assert P.select_sources(off, key="a").count() == 0 and G.source_by_key(off, "a").first().problem == "not active"


@pytest.mark.parametrize("parts", [4])
def test_stream_in_parts_equals_one_batch(spark, small_sf, tmp_path, parts):
    items = load(spark, small_sf, "raw_items")
    landing, root = str(tmp_path / "landing"), str(tmp_path / "stream")
    step = load(spark, small_sf, "documents").count() // parts
    for part in range(parts):
        slice_ = items.where((F.col("arrival") >= part * step) & (F.col("arrival") < (part + 1) * step))
        slice_.repartition(2).write.mode("append").parquet(landing)
        ST.land_fingerprints(spark, landing, items.schema, root)
        ST.dedup_landed(spark, root)
    got = {r.arrival: (r.outcome, r.reason, r.inserted) for r in ST.all_outcomes(spark, root).collect()}
    want = {r.arrival: (r.outcome, r.reason, r.inserted) for r in I.ingest(items).collect()}
    assert got == want and len(want) == parts * step
    ST.land_fingerprints(spark, landing, items.schema, root)
    assert ST.dedup_landed(spark, root).count() == 0


def test_stream_drops_repeats_within_the_watermark(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "h"), ("2024-01-01 00:01:00", "h"), ("2024-01-01 00:02:00", "g")], "t string, content_hash string")
    rows.withColumn("t", F.col("t").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, content_hash string").parquet(str(tmp_path / "in"))
    query = ST.distinct_within(stream, "t", "1 hour").writeStream.format("memory").queryName("distinct_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.content_hash for r in spark.table("distinct_rows").collect()) == ["g", "h"]


def test_both_files_of_the_seed_are_of_one_transform(spark, small_sf, tmp_path):
    seeds = G.transform_registry(load(spark, small_sf, "registry_raw")).withColumn("notes", F.expr("uuid()"))
    G.write_seed(seeds, str(tmp_path / "json"), str(tmp_path / "csv"))
    table = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"').select("canonical_key", "notes")
    written = G.read_seed(spark, str(tmp_path / "json"))
    assert written.count() == table.count() == written.join(table, ["canonical_key", "notes"]).count() > 0
