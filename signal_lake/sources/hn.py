"""Ranked news feed: a list of ids and a table of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.functions.scalars import lookup
from signal_lake.functions.space import is_blank
from signal_lake.sources.common import payload, to_raw_items

DEFAULT_LIMIT = 30
# Address of an item, list behind each feed name, title start a feed asks for.
ITEM_URL = "https://news.ycombinator.com/item?id="
FEED_LISTS = {"showhn": "newstories", "askhn": "newstories"}
TITLE_STARTS = {"showhn": "Show HN", "askhn": "Ask HN"}


def feed_list(feed: Column) -> Column:
    """Name of the ranked list a feed is drawn from."""
    return F.coalesce(lookup(feed, FEED_LISTS), feed)


def wanted(feed: Column, min_score: Column) -> Column:
    """Whether an item is alive, scored high enough and of the kind its feed asks for."""
    alive = ~F.coalesce("deleted", F.lit(False)) & ~F.coalesce("dead", F.lit(False))
    start = lookup(feed, TITLE_STARTS)
    of_kind = start.isNull() | F.coalesce("title", F.lit("")).startswith(start)
    return alive & (F.coalesce("score", F.lit(0)) >= min_score) & of_kind


def pick_items(ranking: DataFrame, items: DataFrame, limit: int = DEFAULT_LIMIT, feed: str = "topstories",
               min_score: int = 0) -> DataFrame:
    """Items of the first ``limit`` places; the filters come after the cut.

    ``ranking``: id, feed_rank (from 1); ``items``: id, title, score, deleted, dead and the rest. The
    cut comes before the join, which meets ``limit`` ids.
    """
    placed = ranking.where(F.col("feed_rank") <= limit).join(items, "id")
    return placed.where(wanted(F.lit(feed), F.lit(min_score)))


def hn_items(items: DataFrame, keep: list[str]) -> DataFrame:
    """``items``: id, title, text, url, by, time (epoch seconds), descendants, score, type, kids."""
    number = F.col("id").cast("string")
    return to_raw_items(
        items,
        keep,
        external_content_id=number,
        source_content_type=F.lit("hn_item"),
        title="title",
        raw_text=F.coalesce("text", F.lit("")),
        url=F.when(~is_blank(F.col("url")), F.col("url")).otherwise(F.concat(F.lit(ITEM_URL), number)),
        author_name="by",
        published_at=F.when(F.col("time") != 0, F.timestamp_seconds("time")),
        engagement_comment_count="descendants",
        raw_payload=payload(
            F.col("id").alias("hn_id"), "score", F.col("type").alias("item_type"),
            F.size(F.coalesce("kids", F.array())).alias("kids_count"),
        ),
    )
