"""The source registry: master list in, ``sources`` rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signal_lake.functions import registry_fields as R
from signal_lake.functions.scalars import lenient_int
from signal_lake.functions.space import is_blank, strip_space
from signal_lake.operators import tables
from signal_lake.operators.skew import keep_first
from signal_lake.schemas import FETCH_CONFIG, REGISTRY_CSV_COLUMNS, SCORE_COLUMNS, SOURCE_SEED
from signal_lake.session import stage
from signal_lake.sources.fragments import csv_fields

# Keys of rows known to repeat another source under a different name.
DROPPED_KEYS = ["reforge-blog-additional", "ilya-krasinsky"]


def read_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the master list, columns by the names of its header, with ``row_no``, their place in the file."""
    rows = stage(csv_fields(spark, path, REGISTRY_CSV_COLUMNS), "registry_list")
    unnamed = rows.where(~F.array_contains("header", "source_name")).select("position.file_path", "header").limit(1).collect()
    if unnamed:
        raise ValueError(f"the list has no column source_name; it has {unnamed[0]['header']}")
    return rows.select(*REGISTRY_CSV_COLUMNS, F.col("position").alias("row_no"))


def registry_fields(rows: DataFrame, order: str = "row_no") -> DataFrame:
    """The described columns of each named row, with ``order``; columns the list lacks count as NULL."""
    lacking = [F.lit(None).cast("string").alias(name) for name in REGISTRY_CSV_COLUMNS if name not in rows.columns]
    named = rows.select("*", *lacking).where(~is_blank(strip_space(F.col("source_name"))))
    name, platform = strip_space(F.col("source_name")), strip_space(F.col("primary_platform"))
    address = strip_space(F.col("url_or_handle"))
    named = named.select("*", R.url_and_handle(address, platform).alias("_address"), R.fetch_method(platform, address).alias("_method"))
    method = F.col("_method")
    tier = lenient_int(F.col("tier"))
    columns: dict[str, Column] = {
        "source_name": name,
        "canonical_name": name,
        "canonical_key": R.canonical_key(name),
        "source_type": R.or_default(F.col("type"), "unknown"),
        "region": R.or_default(F.col("region")),
        "language": R.language(strip_space(F.col("region"))),
        "primary_platform": R.or_default(F.col("primary_platform")),
        "platforms": R.platforms(platform, F.col("secondary_platforms")),
        "url": F.col("_address.url"),
        "handle": F.col("_address.handle"),
        "themes": R.themes(F.col("themes")),
        "signal_type": R.or_default(F.col("signal_type")),
        **{score: lenient_int(F.col(score)).try_cast("smallint") for score in SCORE_COLUMNS},
        "tier": F.coalesce(F.nullif(tier, F.lit(0)), F.lit(3)).try_cast("smallint"),
        "wave": R.wave(method),
        "monitoring_frequency": R.or_default(R.monitoring_frequency(F.col("monitoring_frequency"))),
        "fetch_method": method,
        "fetch_config": F.lit("{}"),
        "is_active": F.lit(True),
        "notes": R.or_default(F.col("why_relevant")),
    }
    return named.select(order, *[columns[f.name].cast(f.dataType).alias(f.name) for f in SOURCE_SEED.fields])


def transform_registry(rows: DataFrame, order: str = "row_no") -> DataFrame:
    """One row per key, the first in file order; keys on the drop list go."""
    fields = registry_fields(rows, order)
    return keep_first(fields.where(~F.col("canonical_key").isin(DROPPED_KEYS)), ["canonical_key"], order)


def load_registry(rows: DataFrame, stored: DataFrame, run_at: Column, order: str = "row_no") -> tuple[DataFrame, DataFrame]:
    """(the ``sources`` table after a load, rows in quarantine with their ``violations``): transform, check, upsert."""
    good, bad = tables.split_quarantine(transform_registry(rows, order))
    return tables.upsert_sources(stored, good, run_at), bad


def flatten(seeds: DataFrame) -> DataFrame:
    """Lists as text joined by ``;``, ready for CSV."""
    return seeds.withColumns(
        {name: F.array_join(F.coalesce(name, F.array()), ";") for name in ("platforms", "themes")}
    ).withColumn("fetch_config", F.coalesce("fetch_config", F.lit("{}")))


def write_seed(seeds: DataFrame, json_path: str, csv_path: str) -> None:
    """Both files of the seed: JSON as it is, CSV flattened. The transform runs once, for both."""
    rows = stage(seeds.select(*SOURCE_SEED.names), "seed")
    rows.write.mode("errorifexists").option("ignoreNullFields", "false").json(json_path)
    flat = flatten(rows)
    flat.write.mode("errorifexists").csv(csv_path, header=True, escape='"', emptyValue="", nullValue="")


def read_seed(spark: SparkSession, json_path: str) -> DataFrame:
    """The seed as written, without a new transform."""
    return spark.read.schema(SOURCE_SEED).json(json_path)


def decode_config(sources: DataFrame) -> DataFrame:
    """``fetch_config`` as a struct and ``platforms`` as a list where they arrive as JSON text."""
    kinds = dict(sources.dtypes)
    decoded = sources
    if kinds.get("fetch_config") == "string":
        decoded = decoded.withColumn("fetch_config", F.from_json("fetch_config", FETCH_CONFIG))
    if kinds.get("platforms") == "string":
        decoded = decoded.withColumn("platforms", F.from_json("platforms", "array<string>"))
    return decoded


def profile(seeds: DataFrame) -> DataFrame:
    """Number and share of sources by tier, type, region and frequency, in one pass over the rows."""
    fields = ["tier", "source_type", "region", "monitoring_frequency"]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    counts = seeds.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n_sources"))
    totals = counts.groupBy("field").agg(F.sum("n_sources").alias("total"))
    return counts.join(totals, "field").select(
        "field", "value", "n_sources", F.round(F.col("n_sources") / F.col("total"), 4).alias("share")
    )


def active_sources(sources: DataFrame, method: str | None = None, wave: int | None = None) -> DataFrame:
    """Active sources, of one method or wave if asked for; the order is ``processing_order``."""
    chosen = sources.where("is_active")
    if method:
        chosen = chosen.where(F.col("fetch_method") == method)
    if wave is not None:
        chosen = chosen.where(F.col("wave") == wave)
    return chosen


def processing_order() -> list[str]:
    """Sort columns of a run; names compare by bytes."""
    return ["tier", "wave", "source_name", "canonical_key"]


def keys_with_problem(sources: DataFrame, keys: DataFrame) -> DataFrame:
    """(canonical_key, problem) of every asked key: NULL if its source can run."""
    found = keys.select("canonical_key").join(sources.select("canonical_key", "is_active"), "canonical_key", "left")
    problem = F.when(F.col("is_active").isNull(), "not found").when(~F.col("is_active"), "not active")
    return found.select("canonical_key", problem.alias("problem"))


def source_by_key(sources: DataFrame, key: str) -> DataFrame:
    """The source with its state: ``problem`` is NULL if it can run."""
    return sources.where(F.col("canonical_key") == key).withColumn(
        "problem", F.when(~F.col("is_active"), F.lit("not active"))
    )
