"""Which connector serves a source, and why a source cannot be fetched."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.functions.space import is_blank
from signal_lake.schemas import FETCH_CONFIG
from signal_lake.sources import channel, feeds, hf, hn, manual, transcript, web
from signal_lake.sources.transcript import source_videos

Mapper = Callable[[DataFrame, list[str]], DataFrame]

# Methods that are named but have no connector behind them.
PLANNED = ["x_api", "linkedin_api"]

_connectors: dict[str, Mapper] = {
    "rss": feeds.feed_items,
    "telegram_api": channel.message_items,
    "youtube_transcript": transcript.transcript_items,
    "hn_api": hn.hn_items,
    "huggingface_api": hf.listing_items,
    "web_scraper": web.web_items,
    "site_change_monitor": web.web_items,
    "manual_import": manual.manual_items,
}


def register_connector(method: str, mapper: Mapper) -> None:
    """Add or replace the mapper of a fetch method: (landed records, columns to keep) -> raw items."""
    _connectors[method] = mapper


def has_connector(method: str) -> bool:
    return method in _connectors


def known_methods() -> list[str]:
    return [*_connectors, *[name for name in PLANNED if name not in _connectors]]


def route(landed: dict[str, DataFrame], keep: list[str]) -> DataFrame:
    """Raw items of all landed tables, each by the connector of its method, as one table."""
    parts = []
    for method, records in landed.items():
        if method not in _connectors:
            raise KeyError(f"no connector for {method!r}; there are {known_methods()}")
        parts.append(_connectors[method](records, keep).withColumn("fetch_method", F.lit(method)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def unroutable(method: Column) -> Column:
    return method.isNull() | ~method.isin(known_methods())


def fetch_error(sources: DataFrame) -> Column:
    """Why a source cannot be fetched at all, NULL if it can."""
    config = F.from_json("fetch_config", FETCH_CONFIG) if dict(sources.dtypes)["fetch_config"] == "string" else F.col("fetch_config")
    method, url = F.col("fetch_method"), F.col("url")
    no_url = is_blank(url)
    path, fmt = config["file_path"], manual.file_format(config["file_path"], config["file_format"])
    return (
        F.when(unroutable(method), F.concat(F.lit("no connector for "), F.coalesce(method, F.lit("NULL"))))
        .when(method.isin([name for name in PLANNED if name not in _connectors]), F.concat(method, F.lit(" is not implemented")))
        .when((method == "rss") & is_blank(config["feed_url"]) & no_url, "no feed address")
        .when((method == "telegram_api") & is_blank(config["channel"]) & is_blank(F.col("handle")), "no channel")
        .when((method == "youtube_transcript") & (F.size(source_videos(config["video_ids"], url)) == 0), "no video ids")
        .when(
            (method == "huggingface_api") & ~F.coalesce(config["feed"], F.lit(hf.FEEDS[0])).isin(hf.FEEDS),
            F.concat(F.lit("unknown feed "), config["feed"]),
        )
        .when(
            method.isin("web_scraper", "site_change_monitor") & (F.coalesce(F.size(config["urls"]), F.lit(0)) <= 0) & no_url,
            "no address to scrape",
        )
        .when((method == "manual_import") & is_blank(path), "no import file")
        .when((method == "manual_import") & ~fmt.isin(manual.FORMATS), F.concat(F.lit("unsupported format "), fmt))
    )


def source_errors(sources: DataFrame) -> DataFrame:
    """Sources that cannot be fetched: canonical_key, fetch_method, message, and whether the source notes it.

    A method without a connector counts as an error of the run but is not written to the source.
    """
    return (
        sources.withColumn("message", fetch_error(sources))
        .where(F.col("message").isNotNull())
        .select("canonical_key", "fetch_method", "message", (~unroutable(F.col("fetch_method"))).alias("recorded"))
    )
