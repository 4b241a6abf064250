"""What each source asks of its connector: limits, cursors and selectors, applied to landed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signal_lake.functions.space import is_blank
from signal_lake.operators.skew import first_n, large_lookup_join
from signal_lake.plans.registry import decode_config
from signal_lake.sources import channel, feeds, hf, hn, transcript

# Setting that limits a source and its default, by method.
LIMITS = {
    "rss": ("max_items", feeds.DEFAULT_LIMIT),
    "telegram_api": ("limit", channel.DEFAULT_LIMIT),
    "hn_api": ("limit", hn.DEFAULT_LIMIT),
    "huggingface_api": ("limit", hf.DEFAULT_LIMIT),
    "youtube_transcript": ("max_videos", transcript.DEFAULT_LIMIT),
}


def pick_landed(method: str, records: DataFrame, sources: DataFrame, cursors: DataFrame | None = None) -> DataFrame:
    """Records (with ``source_id`` and ``pos``) of the sources of ``method``, cut as each source is set up.

    ``cursors`` (source_id, min_id) tell how far channels were read; a source's own setting holds if it is further.

    Only the greatest limit comes to the driver, one number; it bounds the cut before the shuffle.
    """
    setting, default = LIMITS.get(method, (None, None))
    config = decode_config(sources.where(F.col("fetch_method") == method))
    wish = config.select(
        F.col("id").alias("source_id"),
        F.coalesce(F.col(f"fetch_config.{setting}"), F.lit(default)).alias("_limit") if setting else F.lit(0).alias("_limit"),
        F.coalesce("fetch_config.min_id", F.lit(0)).cast("bigint").alias("_min_id"),
        F.coalesce("fetch_config.feed", F.lit(hf.FEEDS[0] if method == "huggingface_api" else "topstories")).alias("_feed"),
        F.coalesce("fetch_config.sort", F.lit("likes")).alias("_sort"),
        F.coalesce("fetch_config.languages", F.array(*map(F.lit, transcript.DEFAULT_LANGUAGES))).alias("_languages"),
        transcript.source_videos(F.col("fetch_config.video_ids"), F.col("url"), F.coalesce("fetch_config.max_videos", F.lit(transcript.DEFAULT_LIMIT))).alias("_videos"),
        F.coalesce("fetch_config.min_score", F.lit(0)).alias("_min_score"),
        F.col("fetch_config.content_selector").alias("content_selector"),
        F.col("fetch_config.title_selector").alias("title_selector"),
    )
    if cursors is not None and method == "telegram_api":
        read_to = cursors.select("source_id", F.col("min_id").alias("_read_to"))
        wish = wish.join(read_to, "source_id", "left").withColumn("_min_id", F.greatest("_min_id", F.coalesce("_read_to", F.lit(0)))).drop("_read_to")
    own = [name for name in ("content_selector", "title_selector") if name not in records.columns]
    joined = large_lookup_join(records.drop("content_selector", "title_selector"), wish, "source_id", "pos")
    if setting:
        if method == "telegram_api":
            joined = joined.where(F.col("msg_id") > F.col("_min_id"))
        if method == "hn_api" and "list" in records.columns:
            joined = joined.where(F.col("list") == hn.feed_list(F.col("_feed")))
        if method == "youtube_transcript" and "video_id" in records.columns:
            joined = joined.where(F.array_contains("_videos", F.col("video_id")))
            if {"lang", "is_generated"} <= set(records.columns):
                chosen = transcript.pick_transcript(joined, ["source_id", "video_id"], F.col("_languages"))
                joined = joined.join(chosen, ["source_id", "video_id", "lang", "is_generated"], "left_semi")
        order = [F.col("msg_id").desc()] if method == "telegram_api" else [F.col("pos")]
        if method == "huggingface_api":
            value = F.expr("TRY_CAST(get_json_object(json, concat('$.', _sort)) AS DOUBLE)")
            order = [F.when(F.col("_feed") == hf.FEEDS[1], value).desc_nulls_last(), *order]
            joined = joined.withColumn("feed", F.col("_feed"))
        bound = wish.agg(F.max("_limit")).first()[0] or default
        joined = first_n(joined, ["source_id"], order, F.col("_limit"), bound)
        if method == "telegram_api":
            joined = joined.where(~is_blank(F.col("text")))
        if method == "hn_api":
            joined = joined.where(hn.wanted(F.col("_feed"), F.col("_min_score")))
    dropped = ["_limit", "_min_id", "_feed", "_min_score", "_sort", "_languages", "_videos"]
    if method not in ("web_scraper", "site_change_monitor"):
        dropped += own
    return joined.drop(*dropped)
