"""Channel message dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.functions.space import is_blank
from signal_lake.operators.skew import first_n
from signal_lake.sources.common import payload, to_raw_items

DEFAULT_LIMIT = 50


def pick_messages(
    messages: DataFrame, keys: list[str], limit: Column | int = DEFAULT_LIMIT, min_id: Column | int = 0,
    bound: int = DEFAULT_LIMIT,
) -> DataFrame:
    """The newest ``limit`` messages above ``min_id`` of each channel; empty ones go after the cut."""
    newer = messages.where(F.col("msg_id") > (min_id if isinstance(min_id, Column) else F.lit(min_id)))
    newest = first_n(newer, keys, [F.col("msg_id").desc()], limit, bound)
    return newest.where(~is_blank(F.col("text")))


def message_url(channel: Column, msg_id: Column) -> Column:
    name = F.ltrim(channel, F.lit("@"))
    return F.when(~is_blank(channel), F.concat(F.lit("https://t.me/"), name, F.lit("/"), msg_id.cast("string")))


def message_items(messages: DataFrame, keep: list[str]) -> DataFrame:
    """``messages``: msg_id, channel, text, date, views, replies, has_media, grouped_id."""
    return to_raw_items(
        messages,
        keep,
        external_content_id=F.col("msg_id").cast("string"),
        source_content_type=F.lit("tg_message"),
        raw_text="text",
        url=message_url(F.col("channel"), F.col("msg_id")),
        published_at="date",
        engagement_view_count="views",
        engagement_comment_count="replies",
        raw_payload=payload(F.col("msg_id").alias("message_id"), "has_media", "grouped_id"),
    )


def cursor(messages: DataFrame, keys: list[str]) -> DataFrame:
    """The greatest message id of each channel: ``min_id`` of the next run."""
    return messages.groupBy(*keys).agg(F.max("msg_id").alias("min_id"))
