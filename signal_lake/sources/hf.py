"""Daily papers and trending models, landed as the JSON of the listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from signal_lake.functions.space import or_null
from signal_lake.operators.skew import first_n
from signal_lake.sources.common import payload, to_raw_items

DEFAULT_LIMIT = 20
# Addresses and the names of the two listings.
PAPER_URL = "https://huggingface.co/papers/"
MODEL_URL = "https://huggingface.co/"
FEEDS = ["daily_papers", "trending_models"]

_S, _I = T.StringType(), T.IntegerType()
PAPER = T.StructType([
    T.StructField("paper", T.StructType([
        T.StructField("id", _S), T.StructField("title", _S), T.StructField("summary", _S),
        T.StructField("publishedAt", _S),
        T.StructField("authors", T.ArrayType(T.StructType([T.StructField("name", _S)]))),
    ])),
    T.StructField("numComments", _I), T.StructField("upvotes", _I),
])
MODEL = T.StructType([
    T.StructField("id", _S), T.StructField("author", _S), T.StructField("createdAt", _S),
    T.StructField("tags", T.ArrayType(_S)), T.StructField("likes", _I), T.StructField("downloads", _I),
    T.StructField("pipeline_tag", _S),
])


def wall_clock(text: Column) -> Column:
    """Timestamp of an ISO text read as UTC: an offset is discarded, the wall clock stays."""
    iso = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2}(?:[.,][0-9]+)?)?)?)?\z"
    local = F.regexp_replace(text, r"(?:Z+|[+-][0-9]{2}:?[0-9]{2})\z", "")
    time = F.substring(local, 12, 15)
    missing = F.when(F.length(local) == 10, "00:00:00").when(F.length(local) == 13, ":00:00").when(F.length(local) == 16, ":00")
    moment = F.concat(F.substring(local, 1, 10), F.lit("T"), time, F.coalesce(missing, F.lit("")))
    return F.when(local.rlike(iso), F.concat(moment, F.lit("Z")).try_cast("timestamp"))


def pick_models(landed: DataFrame, keys: list[str], sort: str = "likes", limit: int = DEFAULT_LIMIT, json: str = "json") -> DataFrame:
    """The first ``limit`` models of each listing by a number the record holds, greatest first; ties by ``pos``."""
    value = F.get_json_object(json, f"$.{sort}").try_cast("double")
    return first_n(landed, keys, [value.desc_nulls_last(), F.col("pos")], limit, limit)


def paper_items(landed: DataFrame, keep: list[str], json: str = "json") -> DataFrame:
    entries = landed.withColumn("_e", F.from_json(json, PAPER)).where(F.col("_e").isNotNull())
    paper = F.col("_e.paper")
    paper_id = F.coalesce(paper["id"], F.lit(""))
    return to_raw_items(
        entries,
        keep,
        external_content_id=paper_id,
        source_content_type=F.lit("hf_paper"),
        title=paper["title"],
        raw_text=F.coalesce(paper["summary"], F.lit("")),
        url=F.concat(F.lit(PAPER_URL), paper_id),
        author_name=F.get(paper["authors"], F.lit(0))["name"],
        published_at=wall_clock(or_null(paper["publishedAt"])),
        engagement_comment_count=F.col("_e.numComments"),
        raw_payload=payload(
            F.col("_e.upvotes").alias("upvotes"), F.col("_e.numComments").alias("num_comments"), paper_id.alias("paper_id")
        ),
    )


def listing_items(landed: DataFrame, keep: list[str], json: str = "json") -> DataFrame:
    """Records of both listings, each by its own mapper; ``feed`` tells the listing, NULL and no column the papers."""
    if "feed" not in landed.columns:
        return paper_items(landed, keep, json)
    models = F.coalesce(F.col("feed") == FEEDS[1], F.lit(False))
    return paper_items(landed.where(~models), keep, json).unionByName(model_items(landed.where(models), keep, json))


def model_items(landed: DataFrame, keep: list[str], json: str = "json") -> DataFrame:
    models = landed.withColumn("_m", F.from_json(json, MODEL)).where(F.col("_m").isNotNull())
    tags = F.coalesce(F.col("_m.tags"), F.array().cast("array<string>"))
    model_id = F.coalesce("_m.id", F.lit(""))
    listed = F.concat(F.lit("Tags: "), F.array_join(tags, ", "))
    return to_raw_items(
        models,
        keep,
        external_content_id=model_id,
        source_content_type=F.lit("hf_model"),
        title=model_id,
        raw_text=F.when(F.size(tags) > 0, listed).otherwise(F.lit("")),
        url=F.concat(F.lit(MODEL_URL), model_id),
        author_name=F.col("_m.author"),
        published_at=wall_clock(or_null(F.col("_m.createdAt"))),
        raw_payload=payload(
            F.col("_m.likes").alias("likes"), F.col("_m.downloads").alias("downloads"),
            F.col("_m.pipeline_tag").alias("pipeline_tag"), F.slice(tags, 1, 10).alias("tags"),
        ),
    )
