"""Input views over the given tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from signal_lake.operators.skew import global_rank

TABLES = ["documents", "pages", "conversations", "events", "customer"]
# Few bytes on disk, much work per row.
TEXT_TABLES = ["documents", "pages"]
# So many rows of the list are work for a task.
ROWS_A_TASK = 50_000

VIEWS = {
    "raw_items": """
SELECT doc_id AS arrival, source AS source_id,
 CASE WHEN doc_id % 11 = 5 THEN NULL WHEN doc_id % 9 = 4 THEN CAST(doc_id - 20 AS STRING) ELSE CAST(doc_id AS STRING) END AS external_content_id,
 CASE CAST(substr(source, 4) AS INT) % 4 WHEN 0 THEN 'telegram_api' WHEN 1 THEN 'rss' WHEN 2 THEN 'web_scraper' ELSE 'manual_import' END AS fetch_method,
 CASE CAST(substr(source, 4) AS INT) % 4 WHEN 0 THEN 'tg_message' WHEN 1 THEN 'rss_item' WHEN 2 THEN 'web_page' ELSE 'manual' END AS source_content_type,
 CASE WHEN doc_id % 4 = 2 THEN ' ' || substr(text, 1, 12) END AS title,
 CASE doc_id % 17 WHEN 1 THEN text || chr(10) || 'The post ' || substr(text, 1, 10) || ' appeared first on Blog.'
  WHEN 2 THEN 'Subscribe to our  newsletter' || chr(10) || text
  WHEN 3 THEN text || chr(10) || '[...]' || chr(10) || 'Read the full article here'
  WHEN 4 THEN text || ' erid: 2VtzqX'
  WHEN 5 THEN text || chr(10) || 'Powered by Ghost' || chr(10) || chr(10) || chr(10) || chr(10) || 'tail' || chr(160) || chr(9) || 'end'
  WHEN 6 THEN substr(text, 1, 120) WHEN 7 THEN NULL
  WHEN 8 THEN text || ' utm_source=telegram' ELSE text END AS raw_text,
 CASE doc_id % 6 WHEN 0 THEN '  HTTPS://Ex.org/P/' || CAST(doc_id % 90 AS STRING) || ' ' WHEN 1 THEN ''
  WHEN 3 THEN 'https://ex.org/p/' || CAST(doc_id % 90 AS STRING) END AS url,
 CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS source_language
FROM documents
""",
    "registry_raw": """
SELECT c_custkey AS row_no,
 CASE WHEN c_custkey % 25 = 0 THEN '  ' WHEN c_custkey % 20 = 7 THEN 'Customer__' || CAST(c_custkey - 1 AS STRING) || '!' WHEN c_custkey % 20 = 9 THEN 'Größe ×' || CAST(c_custkey AS STRING) || ' Éclair™' ELSE 'Customer ' || CAST(c_custkey AS STRING) END AS source_name,
 CASE c_custkey % 3 WHEN 0 THEN 'person' WHEN 1 THEN 'media' ELSE '' END AS type,
 CASE c_custkey % 13 WHEN 0 THEN 'TG' WHEN 1 THEN 'X' WHEN 2 THEN 'LI' WHEN 3 THEN 'WEB' WHEN 4 THEN 'FORUM' WHEN 5 THEN 'COMM' WHEN 6 THEN 'TOOL' WHEN 7 THEN 'NEWS' WHEN 8 THEN 'DB/FEED' WHEN 9 THEN 'POD' WHEN 10 THEN 'SS' WHEN 11 THEN 'SB' ELSE 'TG/WEB' END AS primary_platform,
 CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'WEB' WHEN 2 THEN 'SS, LI' ELSE 'LI; POD,TG;;LI' END AS secondary_platforms,
 CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN '@h' || CAST(c_custkey AS STRING) WHEN 2 THEN 't.me/ch' || CAST(c_custkey AS STRING) WHEN 3 THEN 'LI search: ' || c_name WHEN 4 THEN 'https://e.org/' || CAST(c_custkey AS STRING)
  WHEN 5 THEN 'site' || CAST(c_custkey AS STRING) || '.io' WHEN 6 THEN 'launches' WHEN 7 THEN 'reddit.com/r/' || CAST(c_custkey AS STRING) WHEN 8 THEN 'a.com / b.com' WHEN 9 THEN 'news.ycombinator.com' ELSE 'The Review' END AS url_or_handle,
 CASE c_custkey % 3 WHEN 0 THEN 'growth; GTM;; AI ' WHEN 1 THEN '' ELSE lower(c_mktsegment) END AS themes,
 CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN '4.7' WHEN 2 THEN ' 3 ' WHEN 3 THEN 'n/a' WHEN 4 THEN '5' ELSE '0' END AS signal_quality,
 CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE CAST(c_custkey % 3 + 1 AS STRING) END AS tier,
 CASE c_custkey % 4 WHEN 0 THEN 'Daily' WHEN 1 THEN '2-3x_week' WHEN 2 THEN 'weekly ' ELSE 'monthly' END AS monitoring_frequency,
 CASE c_custkey % 5 WHEN 0 THEN 'RU/mixed' WHEN 1 THEN 'EN/global' WHEN 2 THEN 'EN+RU/global' WHEN 3 THEN 'RU' ELSE '' END AS region
FROM customer
""",
    "hn_items": """
SELECT event_id AS id, ts AS time_ts, CASE event_id % 5 WHEN 0 THEN 'Show HN: item ' || CAST(event_id AS STRING) WHEN 1 THEN 'Ask HN: item ' || CAST(event_id AS STRING) ELSE 'Item ' || CAST(event_id AS STRING) END AS title,
 CAST(floor(value) AS INT) AS score, event_type AS type, 'u' || CAST(user_id AS STRING) AS author, event_id % 37 = 0 AS deleted, event_id % 41 = 0 AS dead,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'https://ex.org/' || CAST(event_id % 700 AS STRING) END AS url, props FROM events
""",
    "hn_feed": """
SELECT event_id AS id, row_number() OVER (ORDER BY value DESC, event_id) AS feed_rank FROM events WHERE event_id % 97 <> 5
""",
    "messages": """
SELECT conv_id AS channel_id, turn AS msg_id, CASE WHEN turn % 7 = 6 THEN '' ELSE text END AS text, role FROM conversations
""",
    "pages_marked": """
SELECT page_id, replace(html, '</h1>', ' it&apos;s' || chr(1) || ' so</h1>') AS html FROM pages
""",
    "page_snapshots": """
SELECT page_id, 1 AS snap, url, html FROM pages UNION ALL SELECT page_id, 2 AS snap, url, CASE WHEN page_id % 4 = 0 THEN replace(html, '</article>', '<p>edited</p></article>') WHEN page_id % 8 = 2 THEN replace(html, '</h1>', ' renamed</h1>') ELSE html END AS html FROM pages
""",
    "landed_manual": """
SELECT doc_id AS rec, CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL ELSE CAST(doc_id AS STRING) END AS external_content_id, 'r' || CAST(doc_id AS STRING) AS id, CASE WHEN doc_id % 3 = 0 THEN text END AS raw_text, CASE WHEN doc_id % 3 = 1 THEN text END AS content, text,
 CASE doc_id % 9 WHEN 0 THEN '12' WHEN 1 THEN ' 7 ' WHEN 2 THEN '1.5' WHEN 3 THEN '' WHEN 4 THEN 'x' WHEN 5 THEN NULL WHEN 6 THEN '-3' ELSE '0' END AS engagement_like_count,
 CASE doc_id % 12 WHEN 0 THEN '2024-01-05T10:00:00Z' WHEN 1 THEN '2024-01-05T10:00:00+03:00' WHEN 2 THEN 'Fri, 05 Jan 2024 10:00:00 +0300' WHEN 3 THEN '2024-01-05' WHEN 4 THEN 'garbage'
  WHEN 6 THEN 'Fri, 05 Jan 24 10:00:00 +0300' WHEN 7 THEN '2024-01-05T10:00:00+03' WHEN 8 THEN '2024-01-05 10:00:00+00' WHEN 9 THEN '05 Jan 24 10:00:00 GMT' WHEN 10 THEN '01/05/24' WHEN 11 THEN '2024-01-05 10' END AS published_at FROM documents
""",
    "pages_aug": """
SELECT page_id, url, CASE page_id % 5
  WHEN 0 THEN replace(html, '<title>', '<meta name="a > b" property="og:title" content="OG > it&apos;s ' || CAST(page_id AS STRING) || '"><title>')
  WHEN 1 THEN replace(replace(html, '<article>', '<main>'), '</article>', '</main>')
  WHEN 2 THEN replace(replace(html, '<article>', '<div class="content">'), '</article>', '</div>')
  WHEN 3 THEN replace(replace(html, '<article>', '<section>'), '</article>', '</section>')
  ELSE html END AS html FROM pages
""",
}


def view_sql(name: str) -> str:
    return VIEWS[name].strip()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a view over one."""
    if name not in VIEWS:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        # A table that is one file is read by one task; dealing out one file is bounded by its size.
        single = name in TEXT_TABLES and len(table.inputFiles()) == 1
        return table.repartition(spark.sparkContext.defaultParallelism) if single else table
    if name == "registry_raw":  # narrow rows, however few row groups hold them, and much work on each
        listed = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
        tasks = max(spark.sparkContext.defaultParallelism, listed.count() // ROWS_A_TASK)
        return spark.sql(view_sql(name).replace("FROM customer", "FROM {customer}"), customer=listed.repartition(tasks, "c_custkey"))
    if name == "hn_feed":  # as in the SQL of the view, without one task for all rows
        ranked = global_rank(load(spark, sf_dir, "events").where("event_id % 97 <> 5").select("event_id", "value"), [F.desc("value"), "event_id"], "place")
        return ranked.select(F.col("event_id").alias("id"), (F.col("place") + 1).alias("feed_rank"))
    used = [t for t in TABLES if re.search(rf"FROM {t}\b", VIEWS[name])]
    text = re.sub(r"FROM (\w+)", r"FROM {\1}", view_sql(name))
    return spark.sql(text, **{t: load(spark, sf_dir, t) for t in used})
