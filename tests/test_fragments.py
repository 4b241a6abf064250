"""Files read in pieces against Python's own readers."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from signal_lake.operators.skew import first_cut, first_n
from signal_lake.sources import feed_dumps, feeds, fragments, manual
from test_runs import make_sources


@pytest.fixture
def small_blocks(spark):
    name, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name), spark.conf.get(cost)
    spark.conf.set(name, "700")
    spark.conf.set(cost, "1")
    yield
    spark.conf.set(name, before[0])
    spark.conf.set(cost, before[1])


ODD = ["", "plain", 'a "quoted" word', "two\nlines", "three\n\n\nlines, and", "comma, here", '"', '\n"\n', "Größe 日本", "x" * 900, "}{][", "\\", '\\"', "tail\\\\"]


def test_one_csv_file_in_many_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(5)
    rows = [[str(i), rng.choice(ODD), rng.choice(ODD), rng.choice(ODD)] for i in range(400)]
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\r\n").writerows([["id", "title", "other", "raw_text"], *rows])
    (tmp_path / "a.csv").write_bytes(out.getvalue().encode())
    pieces = fragments.read_fragments(spark, str(tmp_path / "a.csv"), "\n")
    assert pieces.select("block_start").distinct().count() > 20
    got = sorted((int(r.id), r.title or "", r.raw_text or "") for r in manual.read_csv(spark, str(tmp_path / "a.csv")).collect())
    assert got == sorted((int(a), b, d) for a, b, _, d in rows)
    order = [int(r.id) for r in manual.read_csv(spark, str(tmp_path / "a.csv")).orderBy("position").collect()]
    assert order == list(range(400))


def test_headers_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffid,"title"\n1,T\n\n2\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('"raw\ntext",raw_text,id\nx,y,3', encoding="utf-8")
    (tmp_path / "c.csv").write_text("id,title\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    got = {(r.id, r.title, r.raw_text) for r in manual.read_csv(spark, str(tmp_path / "*.csv")).collect()}
    assert got == {("1", "T", None), ("2", None, None), ("3", None, "y")}


def test_one_json_list_in_many_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(6)

    def value(depth=0):
        kind = rng.randrange(6 if depth < 3 else 3)
        if kind < 3:
            return rng.choice([*ODD, 7, None, True])
        return [value(depth + 1) for _ in range(rng.randrange(3))] if kind == 3 else {rng.choice(ODD) + str(k): value(depth + 1) for k in range(rng.randrange(4))}

    entries = []
    for i in range(300):
        entries.append({"id": f"r{i}", "content": rng.choice(ODD), "extra": value()})
        entries += [value(2) for _ in range(rng.randrange(2))]
    want = [e for e in entries if isinstance(e, dict)]
    for name, indent in (("flat", None), ("wide", 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps(entries, indent=indent, ensure_ascii=False), encoding="utf-8")
        records, rejected = manual.read_json(spark, str(tmp_path / f"{name}.json"))
        assert fragments.read_fragments(spark, str(tmp_path / f"{name}.json"), "}").select("block_start").distinct().count() > 20
        got = [json.loads(r.record) for r in records.orderBy("position").collect()]
        assert rejected.count() == 0 and got == want


def test_files_that_hold_no_list(spark, tmp_path):
    texts = {
        "list": '[{"id": "a"}]', "none": "[]", "numbers": "[1, 2]", "object": '{"id": "x"}', "cut": '[{"id": "a"}, {"id": "b"', "open": '[{"id": "a"}', "text": '[{"id": "a}]',
        "empty": "", "word": "hello", "broken": '[{"id": "a"}, {"id" "b"}]', "brace": '["}", "{", {"id": "c", "t": "]}"}]',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    records, rejected = manual.read_json(spark, str(tmp_path / "*.json"))
    assert {r.file_path.rsplit("/", 1)[1][:-5] for r in rejected.collect()} == {"object", "cut", "open", "text", "word", "broken"}
    assert sorted(r.id for r in records.collect()) == ["a", "c"]


def test_sources_name_their_imports(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"id": "1", "text": "one"}, 5, {"id": "2", "text": "two"}]', encoding="utf-8")
    (tmp_path / "y.txt").write_text("id,text\n7,seven\n", encoding="utf-8")
    (tmp_path / "z.json").write_text("{}", encoding="utf-8")
    config = {"a": {"file_path": f"{tmp_path}/x.json"}, "b": {"file_path": f"{tmp_path}/y.txt", "file_format": "CSV"}, "c": {"file_path": f"{tmp_path}/z.json"}, "d": {"file_path": f"{tmp_path}/gone.csv"}, "e": {"file_path": f"{tmp_path}/x.json"}}
    sources = make_sources(spark, [(k, "manual_import", "en", 1, None, None) for k in config])
    texts = F.create_map(*[F.lit(x) for k, v in config.items() for x in (k, json.dumps(v))])
    records, failures = manual.read_source_imports(spark, sources.withColumn("fetch_config", F.try_element_at(texts, F.col("canonical_key"))))
    ids = {r.id: r.canonical_key for r in sources.collect()}
    got = sorted((ids[r.source_id], r.pos, r.id, r.text) for r in records.collect())
    assert [(k, i, t) for k, _, i, t in got] == [("a", "1", "one"), ("a", "2", "two"), ("b", "7", "seven"), ("e", "1", "one"), ("e", "2", "two")]
    assert {tuple(r) for r in failures.collect()} == {("c", "import file must hold a list of records"), ("d", "no import file")}


def test_a_large_limit_of_one_group_leaves_the_others_cut(spark):
    rows = spark.range(0, 20000, 1, 8).selectExpr("id", "IF(id % 4 = 0, 'large', concat('g', id % 3)) AS k").withColumn("n", F.when(F.col("k") == "large", 1_000_000).otherwise(5))
    left = {r.k: r["count"] for r in first_cut(rows, ["k"], [F.col("id")], F.col("n"), 1_000_000).groupBy("k").count().collect()}
    assert left["large"] == 5000 and all(n <= 5 * 8 for k, n in left.items() if k != "large")
    got = {r.k: r["count"] for r in first_n(rows, ["k"], [F.col("id")], F.col("n"), 1_000_000).groupBy("k").count().collect()}
    assert got == {"large": 5000, "g0": 5, "g1": 5, "g2": 5}


RSS_ROOT = '<?xml version="1.0"?>\n<!-- <item> --><rss version="2.0" xmlns:media="http://x/"><channel><title>c</title><image><title>i</title></image>'
ATOM_ROOT = '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:title>c</a:title>'
TEXTS = ["plain", "two\nlines", "a &lt;item&gt; b", "<![CDATA[ x <item> </item> > ]]>", "<![CDATA[<!-- open]]>", "<!-- <item>no</item> -->t", "<![CDATA[a]]> b <![CDATA[ --> ]]>", "<!-- a > b <![CDATA[ <item> ]]> -->u", "w " * 400, ""]
BETWEEN = ["", "\n", "<!-- <item><title>no</title></item> -->", "<ttl>5</ttl>", "<media:item>m</media:item>", "<!-- <entry> - > </entry> -->"]


def test_feed_files_in_many_blocks_against_whole_feeds(spark, tmp_path, small_blocks):
    rng = random.Random(8)

    def rss(i):
        return f"<item><title>T{i}</title><guid>g{i}</guid><description>{rng.choice(TEXTS)}</description></item>" + rng.choice(BETWEEN)

    def atom(i):
        return f"<a:entry ><a:title>T{i}</a:title><a:id>g{i}</a:id><a:summary>{rng.choice(TEXTS).replace('item', 'a:entry')}</a:summary></a:entry>" + rng.choice(BETWEEN)

    files = {
        "rss": RSS_ROOT + "".join(map(rss, range(50))) + "</channel></rss>\n",
        "atom": ATOM_ROOT + "".join(map(atom, range(50))) + "</a:feed>",
        "cut": RSS_ROOT + "".join(map(rss, range(25))) + "<item><title>lost</title><desc",
        "one": "<rss><channel><item><title>T</title></item></channel></rss>",
        "self": "<rss><channel><item/><item><title>U</title></item></channel></rss>",
        "root": "<channel><item><title>V</title></item></channel>",
        "empty": "<rss><channel><title>none</title></channel></rss>",
        "bare": "<feed/>",
        "open": "<rss><channel><title>none</title>",
        "part": "<rss><channel><title>none</title><item><title>x",
        "page": "<html><body><item>x</item><p>" + "text " * 300 + "</p></body></html>",
        "text": "no markup at all",
    }
    for name, xml in files.items():
        (tmp_path / name).write_text(xml, encoding="utf-8")
    entries, errors = feed_dumps.dump_entries(spark, str(tmp_path))
    whole, failed = feeds.feed_entries(feeds.read_feeds(spark, str(tmp_path)), ["file_path"])

    def shown(frame):
        return sorted((r.file_path.rsplit("/", 1)[1], r.pos, r.title or "", r.entry_id or "", r.summary or "") for r in frame.collect())

    got = shown(entries)
    assert len(got) == 50 + 50 + 25 + 4 and got == shown(whole)
    assert sorted((r.file_path.rsplit("/", 1)[1], r.pos) for r in errors.collect()) == sorted((r.file_path.rsplit("/", 1)[1], None) for r in failed.collect())
    assert {r.file_path.rsplit("/", 1)[1] for r in failed.collect()} == {"open", "part", "page", "text"}


def test_a_broken_entry_costs_no_other(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rss><channel><item><title>A</title></item><item><title>B</item><item><title>C</title></item></channel></rss>")
    entries, errors = feed_dumps.dump_entries(spark, str(tmp_path))
    assert sorted((r.pos, r.title) for r in entries.collect()) == [(0, "A"), (2, "C")]
    assert [(r.pos, r.message) for r in errors.collect()] == [(1, "entry parse error")]


def test_last_before_in_many_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(9)
    words = [rng.choice(["on", "off", "-", "-", "-" * 60]) for _ in range(200)]
    (tmp_path / "a.txt").write_text(">".join(words))
    pieces = fragments.read_fragments(spark, str(tmp_path / "a.txt"), ">")
    assert pieces.select("block_start").distinct().count() > 3
    told = fragments.with_last_before(pieces, F.when(F.col("value") == "on", True).when(F.col("value") == "off", False), "is_on")
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file_path" in plan and "SinglePartition" not in plan
    want, state = [], False
    for word in words:
        want.append((word, state))
        state = {"on": True, "off": False}.get(word, state)
    assert [(r.value, r.is_on) for r in told.orderBy("block_start", "place").collect()] == want
