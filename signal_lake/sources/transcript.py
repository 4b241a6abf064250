"""Video transcripts from landed segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.functions.text import video_id
from signal_lake.sources.common import payload, to_raw_items

DEFAULT_LIMIT = 10
DEFAULT_LANGUAGES = ["ru", "en"]
WATCH_URL = "https://www.youtube.com/watch?v="
SEGMENTS_PER_BLOCK = 1000


def pick_transcript(candidates: DataFrame, keys: list[str], languages: list[str] | Column | None = None) -> DataFrame:
    """The transcript to use of each video: by language preference, manual before generated.

    Without one in a preferred language any manual one will do (least language code), and a video with
    generated ones in other languages only is left out. The choice is an aggregate, combined map-side. ``languages`` may be a
    column, each source's own list.
    """
    wanted = languages if isinstance(languages, Column) else F.array(*[F.lit(code) for code in languages or DEFAULT_LANGUAGES])
    place = F.array_position(wanted, F.col("lang"))
    usable = candidates.where((place > 0) | ~F.col("is_generated"))
    rank = F.struct(F.when(place > 0, place).otherwise(F.size(wanted) + 1), F.col("is_generated"), F.col("lang"))
    return usable.groupBy(*keys).agg(
        F.min(rank)["lang"].alias("lang"), F.min(rank)["is_generated"].alias("is_generated")
    )


def assemble(segments: DataFrame, keys: list[str], pos: str = "pos", text: str = "text") -> DataFrame:
    """Segment texts of each video joined by a blank in order, and their number.

    Segments are joined per block of positions first, so that no task gathers the single segments
    of a long video; the last step holds the blocks of the text it returns.
    """

    def joined(place: str, part: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(place, part)))
        return F.array_join(F.transform(ordered, lambda s: s[part]), " ")

    blocks = (
        segments.withColumn("_block", F.floor(F.col(pos) / SEGMENTS_PER_BLOCK))
        .groupBy(*keys, "_block")
        .agg(joined(pos, text).alias("_part"), F.count(text).alias("_n"))
    )
    return blocks.groupBy(*keys).agg(joined("_block", "_part").alias("text"), F.sum("_n").alias("segment_count"))


def transcript_items(videos: DataFrame, keep: list[str]) -> DataFrame:
    """``videos``: video_id, canonical_name, lang, is_generated, text, segment_count."""
    return to_raw_items(
        videos,
        keep,
        external_content_id="video_id",
        source_content_type=F.lit("yt_video"),
        raw_text="text",
        url=F.concat(F.lit(WATCH_URL), F.col("video_id")),
        author_name="canonical_name",
        raw_payload=payload(
            "video_id", F.col("lang").alias("transcript_language"), "is_generated", "segment_count"
        ),
    )


def source_videos(video_ids: Column, url: Column, max_videos: Column | int = DEFAULT_LIMIT) -> Column:
    """The first ids a source names itself, else the one in its address, else an empty array."""
    found = video_id(url)
    own = F.when(found.isNotNull(), F.array(found)).otherwise(F.array().cast("array<string>"))
    ids = F.when(F.coalesce(F.size(video_ids), F.lit(0)) > 0, video_ids).otherwise(own)
    return F.slice(ids, F.lit(1), max_videos if isinstance(max_videos, Column) else F.lit(max_videos))
