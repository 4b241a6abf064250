"""Table schemas and the fixed value sets of the two tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _H, _B, _TS = T.StringType(), T.IntegerType(), T.ShortType(), T.BooleanType(), T.TimestampType()
_L = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Columns, allowed values and defaults of the stored tables.
FETCH_METHODS = [
    "rss", "telegram_api", "youtube_transcript", "hn_api", "web_scraper",
    "site_change_monitor", "manual_import", "x_api", "linkedin_api", "huggingface_api",
]
CONTENT_STATUSES = [
    "new", "normalized", "deduplicated", "filtered", "candidate", "selected", "drafted", "published", "error",
]
SCORE_COLUMNS = [
    "signal_quality", "early_signal_potential", "startup_signal_value", "content_adaptation_value", "brand_fit",
]
ENGAGEMENT_COLUMNS = [
    "engagement_like_count", "engagement_comment_count", "engagement_repost_count", "engagement_view_count",
]
REGISTRY_CSV_COLUMNS = [
    "source_name", "type", "primary_platform", "secondary_platforms", "url_or_handle", "themes", "signal_type",
    *SCORE_COLUMNS, "tier", "monitoring_frequency", "region", "why_relevant",
]

# Parameters a source may carry for its connector.
FETCH_CONFIG = T.StructType([
    T.StructField("feed_url", _S), T.StructField("max_items", _I),
    T.StructField("channel", _S), T.StructField("limit", _I), T.StructField("min_id", T.LongType()),
    T.StructField("feed", _S), T.StructField("min_score", _I), T.StructField("sort", _S),
    T.StructField("video_ids", _L), T.StructField("languages", _L), T.StructField("max_videos", _I),
    T.StructField("urls", _L), T.StructField("content_selector", _S), T.StructField("title_selector", _S),
    T.StructField("file_path", _S), T.StructField("file_format", _S),
])

REGISTRY_CSV = _struct(**{name: _S for name in REGISTRY_CSV_COLUMNS})

# What the registry transform yields and an upsert overwrites (all but the key).
SOURCE_SEED = _struct(
    source_name=_S, canonical_name=_S, canonical_key=_S, source_type=_S, region=_S, language=_S,
    primary_platform=_S, platforms=_L, url=_S, handle=_S, themes=_L, signal_type=_S,
    **{name: _H for name in SCORE_COLUMNS},
    tier=_H, wave=_H, monitoring_frequency=_S, fetch_method=_S, fetch_config=_S, is_active=_B, notes=_S,
)

SOURCES = T.StructType([
    T.StructField("id", _S), *SOURCE_SEED.fields,
    T.StructField("error_count", _I), T.StructField("last_error_at", _TS), T.StructField("last_error_msg", _S),
    T.StructField("last_checked_at", _TS), T.StructField("created_at", _TS), T.StructField("updated_at", _TS),
])

RAW_ITEMS = _struct(
    source_id=_S, external_content_id=_S, source_content_type=_S, title=_S, raw_text=_S, url=_S, author_name=_S,
    published_at=_TS, **{name: _I for name in ENGAGEMENT_COLUMNS}, raw_payload=_S,
)

CONTENT_ITEMS = _struct(
    id=_S, source_id=_S, external_content_id=_S, content_type=_S, source_content_type=_S, title=_S, content_text=_S,
    normalized_text=_S, summary_raw=_S, url=_S, author_name=_S, published_at=_TS, fetched_at=_TS,
    **{name: _I for name in ENGAGEMENT_COLUMNS},
    raw_payload=_S, content_hash=_S, language=_S, status=_S, is_duplicate=_B, topic_cluster_id=_S, created_at=_TS,
)
