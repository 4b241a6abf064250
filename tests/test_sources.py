from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from signal_lake.schemas import RAW_ITEMS
from signal_lake.sources import channel, feeds, hf, hn, manual, router, transcript, web


def epoch(column):
    return F.unix_seconds(column)


def test_manual_json(spark, tmp_path):
    good = [
        {"id": "a", "external_content_id": "", "content": "c", "text": "t", "date": "2024-01-05", "engagement_like_count": "7", "extra": [1]},
        {"id": 5, "raw_text": "r", "author": "me", "engagement_view_count": 9, "title": "T1"},
    ]
    (tmp_path / "good.json").write_text(json.dumps(good, indent=1), encoding="utf-8")
    (tmp_path / "object.json").write_text('{"id": "x"}', encoding="utf-8")
    (tmp_path / "broken.json").write_text('[{"id": "x"', encoding="utf-8")
    records, rejected = manual.read_json(spark, [str(tmp_path / n) for n in ("good.json", "object.json", "broken.json")])
    assert sorted(r.file_path.rsplit("/", 1)[1] for r in rejected.collect()) == ["broken.json", "object.json"]
    items = manual.manual_items(records, ["position"]).orderBy("position").collect()
    assert [(i.external_content_id, i.raw_text, i.author_name, i.title) for i in items] == [("a", "c", None, None), ("5", "r", "me", "T1")]
    assert [i.engagement_like_count for i in items] == [7, None] and items[1].engagement_view_count == 9
    assert json.loads(items[0].raw_payload) == {"source_record": good[0]}
    strict = manual.manual_items(manual.strict_records(records), ["position"]).collect()
    assert [i.external_content_id for i in strict] == ["a"]


def test_manual_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,title,raw_text,engagement_like_count\n1,"a ""q""","two\nlines",3\n2,,x,1.5\n', encoding="utf-8")
    items = manual.manual_items(manual.read_csv(spark, str(tmp_path / "m.csv")), ["position"]).orderBy("position").collect()
    assert [(i.external_content_id, i.title, i.raw_text, i.engagement_like_count) for i in items] == [
        ("1", 'a "q"', "two\nlines", 3), ("2", None, "x", None)
    ]
    assert json.loads(items[0].raw_payload)["source_record"]["raw_text"] == "two\nlines"


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,title,raw_text\n1,T,x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("raw_text,id,author\ny,2,me\n", encoding="utf-8")
    records, rejected = manual.read_import(spark, str(tmp_path / "*.csv"))
    items = manual.manual_items(records, []).orderBy("external_content_id").collect()
    assert rejected is None
    assert [(i.external_content_id, i.title, i.raw_text, i.author_name) for i in items] == [("1", "T", "x", None), ("2", None, "y", "me")]
    with pytest.raises(ValueError):
        manual.read_import(spark, str(tmp_path / "a.xlsx"))


def test_entries_that_are_no_records_are_left_out(spark, tmp_path):
    (tmp_path / "odd.json").write_text('["str", 5, {"id": "a", "text": "t"}, null, [1]]', encoding="utf-8")
    records, rejected = manual.read_import(spark, str(tmp_path / "odd.json"))
    assert [r.id for r in records.collect()] == ["a"] and rejected.count() == 0


def test_manual_formats(spark):
    frame = spark.createDataFrame([("/d/a.JSON", None), ("/d/b.txt", "CSV"), ("/d/c.xlsx", ""), ("/d/none", None)], "p string, f string")
    assert [r[0] for r in frame.select(manual.file_format(F.col("p"), F.col("f"))).collect()] == ["json", "csv", "xlsx", ""]


RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>c</title>
<item><title>T1</title><link>https://e.org/1</link><description>&lt;p&gt;one&lt;/p&gt;</description><content:encoded>long</content:encoded>
<guid isPermaLink="false">0042</guid><pubDate>Fri, 05 Jan 2024 10:00:00 +0300</pubDate><dc:creator>Ann</dc:creator><category>a</category><category>b</category></item>
<item><title>T2</title><link>https://e.org/2</link><content:encoded><![CDATA[<b>two</b>]]></content:encoded></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>c</title>
<entry><title type="text">A1</title><link rel="self" href="https://e.org/self"/><link href="https://e.org/a1"/><content type="text">plain</content>
<content type="html">rich</content><id>urn:1</id><updated>2024-01-05T10:00:00Z</updated><author><name>Bob</name></author><category term="x"/></entry></feed>"""


def test_feeds(spark, tmp_path):
    for name, text in {"rss": RSS, "atom": ATOM, "empty": "<rss><channel><title>c</title></channel></rss>", "broken": "<html><p>sorry", "one": RSS.replace("</channel>", "")}.items():
        (tmp_path / f"{name}.xml").write_text(text, encoding="utf-8")
    landed = feeds.read_feeds(spark, str(tmp_path)).withColumn("name", F.regexp_extract("file_path", r"([a-z]+)\.xml", 1))
    entries, failed = feeds.feed_entries(landed, ["name"])
    items = feeds.feed_items(entries, ["name", "pos"])
    assert items.columns[2:] == RAW_ITEMS.names
    rows = {(r.name, r.pos): r for r in items.withColumn("at", epoch("published_at")).collect()}
    first, second, atom = rows["rss", 0], rows["rss", 1], rows["atom", 0]
    assert (first.external_content_id, first.raw_text, first.author_name, first.at) == ("0042", "<p>one</p>", "Ann", 1704438000)
    assert json.loads(first.raw_payload) == {"feed_id": "0042", "tags": ["a", "b"]}
    assert (second.external_content_id, second.raw_text, second.at, second.title) == ("https://e.org/2", "<b>two</b>", None, "T2")
    assert (atom.title, atom.url, atom.raw_text, atom.author_name, atom.at) == ("A1", "https://e.org/a1", "rich", "Bob", 1704448800)
    assert json.loads(atom.raw_payload) == {"feed_id": "urn:1", "tags": ["x"]}
    assert "broken" in [r.name for r in failed.collect()] and "empty" not in [r.name for r in failed.collect()]


def test_hn(spark):
    ranking = spark.createDataFrame([(i, i) for i in range(1, 8)], "id bigint, feed_rank int")
    fields = "id bigint, title string, text string, url string, by string, time bigint, descendants int, score int, type string, kids array<bigint>, deleted boolean, dead boolean"
    items = spark.createDataFrame([
        (1, "Show HN: a", "body", "", "ann", 1704448800, 3, 5, "story", [7, 8], None, None),
        (2, "Show HN: b", None, "https://e.org", "bob", 0, None, None, "story", None, False, False),
        (3, "Show HN: c", None, None, None, None, None, 9, None, None, True, None),
        (4, None, None, None, None, None, None, 9, None, None, None, None),
        (7, "Show HN: late", None, None, None, None, None, 9, None, None, None, None),
    ], fields)
    picked = hn.pick_items(ranking, items, limit=5, feed="showhn")
    rows = {r.id: r for r in hn.hn_items(picked, ["id"]).withColumn("at", epoch("published_at")).collect()}
    assert sorted(rows) == [1, 2]
    assert (rows[1].url, rows[1].raw_text, rows[1].at, rows[1].engagement_comment_count) == ("https://news.ycombinator.com/item?id=1", "body", 1704448800, 3)
    assert json.loads(rows[1].raw_payload) == {"hn_id": 1, "score": 5, "item_type": "story", "kids_count": 2}
    assert (rows[2].raw_text, rows[2].at) == ("", None)
    assert [r.id for r in hn.pick_items(ranking, items, min_score=6).orderBy("id").collect()] == [4, 7]
    frame = spark.createDataFrame([("showhn",), ("beststories",), ("askhn",)], "f string")
    assert [r[0] for r in frame.select(hn.feed_list(F.col("f"))).collect()] == ["newstories", "beststories", "newstories"]


def test_hf(spark):
    papers = spark.createDataFrame([
        ('{"paper": {"id": "1", "title": "P", "summary": "s", "publishedAt": "2024-01-05T10:00:00+03:00", "authors": [{"name": "A"}, {"name": "B"}]}, "numComments": 2, "upvotes": 3}',),
        ('{"paper": {"id": "2", "publishedAt": "soon", "authors": []}}',),
    ], "json string")
    rows = hf.paper_items(papers, []).withColumn("at", epoch("published_at")).orderBy("external_content_id").collect()
    assert [(r.author_name, r.at, r.raw_text, r.engagement_comment_count) for r in rows] == [("A", 1704448800, "s", 2), (None, None, "", None)]
    assert json.loads(rows[1].raw_payload) == {"upvotes": None, "num_comments": None, "paper_id": "2"}
    models = spark.createDataFrame([
        (json.dumps({"id": "o/m", "author": "o", "createdAt": "2024-01-05T10:00:00.000Z", "tags": [f"t{i}" for i in range(12)], "likes": 4}),), ('{"id": "n"}',),
    ], "json string")
    rows = hf.model_items(models, []).orderBy(F.desc("external_content_id")).collect()
    assert rows[0].raw_text == "Tags: " + ", ".join(f"t{i}" for i in range(12)) and len(json.loads(rows[0].raw_payload)["tags"]) == 10
    assert (rows[1].raw_text, rows[1].url) == ("", "https://huggingface.co/n")


def test_models_in_the_order_asked_for(spark):
    rows = [("s", i, json.dumps({"id": f"m{i}", "likes": i % 3, "downloads": -i})) for i in range(6)]
    landed = spark.createDataFrame(rows, "source_id string, pos int, json string")
    assert sorted(r.pos for r in hf.pick_models(landed, ["source_id"], limit=3).collect()) == [1, 2, 5]
    assert sorted(r.pos for r in hf.pick_models(landed, ["source_id"], sort="downloads", limit=2).collect()) == [0, 1]


def test_listings_are_told_apart(spark):
    rows = [(1, None, '{"paper": {"id": "1"}}'), (2, "trending_models", '{"id": "o/m", "author": "o"}'), (3, "daily_papers", '{"paper": {"id": "3"}}')]
    landed = spark.createDataFrame(rows, "pos int, feed string, json string")
    items = router.route({"huggingface_api": landed}, ["pos"]).orderBy("pos").collect()
    assert [(i.external_content_id, i.source_content_type) for i in items] == [("1", "hf_paper"), ("o/m", "hf_model"), ("3", "hf_paper")]


FEEDS = {
    "entity": "<rss><channel><item><title>a&nbsp;b &amp; c &bogus; </title><guid isPermaLink='true'>https://e.org/g</guid></item></channel></rss>",
    "rdf": "<rdf:RDF xmlns:rdf='r' xmlns='n'><channel><title>c</title></channel><item rdf:about='x'><title>R</title><link>l</link></item></rdf:RDF>",
    "xhtml": "<feed><entry><title type='xhtml'><div xmlns='h'>a <b>b</b></div></title><id>1</id></entry></feed>",
    "empty": "<rss><channel><title>c</title></channel></rss>", "cut": "<rss><channel><item><title>x</title>", "page": "<html><p>x</p></html>", "text": "no feed", "null": None,
}


def test_kinds_of_feed(spark):
    landed = spark.createDataFrame(list(FEEDS.items()), "name string, xml string")
    entries, failed = feeds.feed_entries(landed, ["name"])
    got = {r.name: (r.title.strip(), r.link, r.entry_id) for r in entries.collect()}
    assert got.pop("xhtml")[0].startswith("a ") and got["rdf"] == ("R", "l", "x")
    assert "entity" in {r.name for r in failed.collect()} | set(got)
    assert {r.name for r in failed.collect()} >= {"page", "text", "null"} and "empty" not in {r.name for r in failed.collect()}


def test_channel(spark):
    rows = [("c", i, "" if i == 9 else f"m{i}") for i in range(1, 11)] + [("d", 1, "x")]
    messages = spark.createDataFrame(rows, "channel_id string, msg_id bigint, text string")
    picked = channel.pick_messages(messages, ["channel_id"], limit=3, min_id=2, bound=3)
    assert sorted(r.msg_id for r in picked.collect()) == [8, 10]
    assert {r.channel_id: r.min_id for r in channel.cursor(messages, ["channel_id"]).collect()} == {"c": 10, "d": 1}
    frame = spark.createDataFrame([("@@a", 1), ("", 2), (None, 3), ("b", 4)], "c string, m bigint")
    assert [r[0] for r in frame.select(channel.message_url(F.col("c"), F.col("m"))).collect()] == ["https://t.me/a/1", None, None, "https://t.me/b/4"]


def test_transcripts(spark):
    candidates = spark.createDataFrame([
        (1, "en", False), (1, "ru", True), (2, "en", True), (2, "en", False), (3, "de", True), (4, "de", False), (4, "fr", False), (5, "de", True), (5, "fr", False),
    ], "video_id int, lang string, is_generated boolean")
    got = {r.video_id: (r.lang, r.is_generated) for r in transcript.pick_transcript(candidates, ["video_id"]).collect()}
    assert got == {1: ("ru", True), 2: ("en", False), 4: ("de", False), 5: ("fr", False)}
    segments = spark.createDataFrame([("v", i, f"w{i}") for i in reversed(range(2500))] + [("u", 0, "only")], "video_id string, pos bigint, text string")
    videos = {r.video_id: r for r in transcript.assemble(segments, ["video_id"]).collect()}
    assert videos["v"].text == " ".join(f"w{i}" for i in range(2500)) and videos["v"].segment_count == 2500
    frame = spark.createDataFrame([(["a"], "https://youtu.be/abcDEF_-123"), ([], "https://youtu.be/abcDEF_-123"), (None, "x"), (None, None)], "v array<string>, u string")
    assert [r[0] for r in frame.select(transcript.source_videos(F.col("v"), F.col("u"))).collect()] == [["a"], ["abcDEF_-123"], [], []]
    assert frame.select(transcript.source_videos(F.array(*map(F.lit, "abc")), F.col("u"), 2)).first()[0] == ["a", "b"]


def test_web_cascades(spark):
    pages = spark.createDataFrame([
        (1, "<title>T</title><div id=content>id</div><main>main <p>x</main>"), (2, "<title>T</title><article></article><main>m</main>tail"),
        (3, "<h1 class='big t'>Head</h1><div class='post-content'>pc</div>"), (4, "<p>a &amp; b</p><script>no</script>"),
    ], "id int, html string").withColumn("url", F.lit("u"))
    got = {r.id: (r.title, r.raw_text) for r in web.web_items(pages, ["id"], title_selector=".t").collect()}
    assert got == {1: ("T", "main\nx"), 2: ("T", "T\nm\ntail"), 3: ("Head", "pc"), 4: (None, "a & b")}
    chosen = {r.id: r.raw_text for r in web.web_items(pages, ["id"], content_selector="#content").collect()}
    assert chosen[1] == "id" and chosen[3] == "pc"


def test_changes(spark):
    shots = spark.createDataFrame([("u", i, f"<article>{'b' if i > 250 else 'a'}</article>") for i in range(0, 500, 50)], "url string, snap int, html string")
    got = {r.snap: r.state for r in web.page_changes(shots, F.floor(F.col("snap") / 100)).collect()}
    assert got == {i: "new" if i == 0 else "changed" if i == 300 else "same" for i in range(0, 500, 50)}
    gaps = spark.createDataFrame([("u", 0, None), ("u", 1, "<p>a"), ("u", 2, None), ("u", 3, None), ("u", 4, "<p>a")], "url string, snap int, html string")
    states = {r.snap: r.state for r in web.page_changes(gaps, F.lit(0)).collect()}
    assert states == {0: "new", 1: "changed", 2: "changed", 3: "same", 4: "changed"}


def test_router(spark):
    frame = spark.createDataFrame([("k1", "rss", None, None, "{}"), ("k2", "nope", "u", None, "{}"), ("k3", "x_api", "u", "@h", "{}"),
        ("k4", "manual_import", None, None, '{"file_path": "/d/x.txt"}'), ("k5", "manual_import", None, None, '{"file_path": "/d/x.csv"}'),
        ("k6", "youtube_transcript", "u", None, '{"video_ids": ["a"]}'), ("k7", "huggingface_api", None, None, '{"feed": "f"}'), ("k8", "rss", None, None, '{"feed_url": "u"}')],
        "canonical_key string, fetch_method string, url string, handle string, fetch_config string")
    got = {r.canonical_key: (r.message, r.recorded) for r in router.source_errors(frame).collect()}
    assert got == {
        "k1": ("no feed address", True), "k2": ("no connector for nope", False), "k3": ("x_api is not implemented", True),
        "k4": ("unsupported format txt", True), "k7": ("unknown feed f", True),
    }
    with pytest.raises(KeyError):
        router.route({"nope": frame}, [])


def test_own_connector(spark):
    router.register_connector("own", lambda records, keep: manual.manual_items(records, keep))
    try:
        landed = {"own": spark.createDataFrame([("s", 1, "a")], "source_id string, pos int, id string"),
                  "rss": spark.createDataFrame([("s", 2, "g")], "source_id string, pos int, entry_id string").selectExpr(
                      "*", "'' AS link", "'t' AS summary", "'' AS content", "'x' AS title", "'' AS author", "'' AS published", "array('q') AS tags")}
        rows = router.route(landed, ["source_id", "pos"]).orderBy("pos").collect()
        assert [(r.fetch_method, r.external_content_id) for r in rows] == [("own", "a"), ("rss", "g")]
    finally:
        router._connectors.pop("own")


def test_kind_of_a_feed_is_its_root_and_cut_feeds_keep_entries(spark):
    atom = 'xmlns:a="http://www.w3.org/2005/Atom"'
    rows = [
        ("prefixed", f"<a:feed {atom}><a:entry><a:title>x</a:title><a:id>1</a:id></a:entry></a:feed>"),
        ("mentions", '<feed><entry><title>x</title><summary><![CDATA[ <channel> <rss version="2.0"> <a:b> ]]></summary></entry></feed>'),
        ("atom link", f'<rss {atom}><channel><a:link rel="self" href="s"/><item><title>t</title><link>http://l</link><a:link href="no"/></item></channel></rss>'),
        ("cut", "<feed><entry><title>x</title></entry><entry><title>y</ti"), ("cut at once", "<feed><entry><title>x</title>"),
        ("rss names", '<rdf:RDF xmlns:rdf="r" xmlns:r="http://purl.org/rss/1.0/"><r:channel/><r:item><r:title>t</r:title></r:item></rdf:RDF>'),
        ("hidden entries", "<feed><other><entry><title>x</title></entry></other></feed>"), ("empty", "<feed></feed>"), ("null", None), ("blank", ""),
        ("prolog", '﻿<?xml version="1.0"?>\n<!-- <feed> --><!DOCTYPE rss [<!ENTITY a "b">]><rss><channel><item><title>t</title></item></channel></rss>'),
        ("empty that mentions", "<rss><channel><description><![CDATA[<item>]]></description></channel></rss>"),
    ]
    entries, failed = feeds.feed_entries(spark.createDataFrame(rows, "k string, xml string"), ["k"])
    assert {(r.k, r.pos, r.title, r.link) for r in entries.collect()} == {
        ("prefixed", 0, "x", None), ("mentions", 0, "x", None), ("atom link", 0, "t", "http://l"), ("cut", 0, "x", None), ("rss names", 0, "t", None), ("prolog", 0, "t", None),
    }
    assert {r.k for r in failed.collect()} == {"cut at once", "hidden entries", "null", "blank"}


def test_changed_pages_are_items_with_their_lines(spark):
    def page(*lines):
        return "<article>" + "".join(f"<p>{line}</p>" for line in lines) + "</article>"

    rows = [("u", 1, page("a", "b")), ("u", 2, page("a", "b")), ("u", 3, page("b", "c", "c")), ("u", 4, None), ("u", 5, page("b", "c", "c")), ("v", 1, page("x"))]
    items = web.changed_items(spark.createDataFrame(rows, "url string, snap int, html string"), F.floor(F.col("snap") / 2)).collect()
    assert {(r.snap, tuple(r.added), tuple(r.removed)) for r in items} == {(3, ("c", "c"), ("a",)), (4, (), ("b", "c", "c")), (5, ("b", "c", "c"), ())}
    by_snap = {r.snap: r for r in items}
    assert by_snap[3].external_content_id == by_snap[5].external_content_id == by_snap[3].url and by_snap[3].url.startswith("u#")
    assert by_snap[3].raw_text == "c\nc" and json.loads(by_snap[3].raw_payload) == {"scraped_url": "u", "removed": ["a"]}
