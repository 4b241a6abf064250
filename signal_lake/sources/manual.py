"""Hand-made imports: a JSON list of records or a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from signal_lake.functions.scalars import parse_datetime, strict_int
from signal_lake.functions.space import is_blank, or_null
from signal_lake.operators.skew import lookup_join
from signal_lake.schemas import ENGAGEMENT_COLUMNS, FETCH_CONFIG
from signal_lake.session import stage
from signal_lake.sources.common import fetched_at, payload, to_raw_items
from signal_lake.sources.fragments import csv_fields, json_entries

# The fields a record may have; the later ones of a pair stand in for the first.
RECORD_FIELDS = [
    "external_content_id", "id", "title", "raw_text", "content", "text", "url", "author_name", "author",
    "published_at", "date", *ENGAGEMENT_COLUMNS,
]
FORMATS = ["json", "csv"]
RECORD = T.StructType([T.StructField(name, T.StringType()) for name in RECORD_FIELDS])


def file_format(file_path: Column, configured: Column) -> Column:
    """The configured format, else the suffix of the path, in lower case."""
    suffix = F.regexp_extract(file_path, r"[^/.][^/]*\.([^./]+)\z", 1)
    return F.lower(F.when(~is_blank(configured), configured).otherwise(suffix))


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of CSV files; columns go by the names of each file's header, all text, those a file lacks are NULL. A file may be of any size."""
    return csv_fields(spark, path, RECORD_FIELDS).drop("header")


def read_import(spark: SparkSession, path: str, fmt: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(records, rejected files) of an import by its format, or else the suffix of its path."""
    kind = (fmt or path.rsplit("/", 1)[-1].rpartition(".")[2]).lower()
    if kind == "json":
        return read_json(spark, path)
    if kind == "csv":
        return read_csv(spark, path), None
    raise ValueError(f"unsupported format {kind}")


def read_json(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, rejected files): a file whose top level is no list yields no record, entries that are no object are left out.

    A file may be of any size; it is read by as many tasks as it has blocks.
    """
    entries, rejected = json_entries(spark, path)
    fields = F.from_json("record", RECORD)
    records = entries.select(F.struct("file_path", "number").alias("position"), "record", fields.alias("_r")).select("position", "record", "_r.*")
    return records, rejected.withColumn("message", F.lit("import file must hold a list of records"))


def _plain_path(path: Column) -> Column:
    """A path as settings write it: a local one without its scheme."""
    return F.regexp_replace(path, r"^file:/+", "/")


def read_source_imports(spark: SparkSession, sources: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """(records with ``source_id`` and ``pos``, failures (canonical_key, message)) of the files that import sources name, by the reader of their format.

    Paths come to the driver, one per source, as any read needs them; files that are missing fail their source alone.
    """
    config = sources.where(F.col("fetch_method") == "manual_import")
    if dict(config.dtypes)["fetch_config"] == "string":
        config = config.withColumn("fetch_config", F.from_json("fetch_config", FETCH_CONFIG))
    path = F.col("fetch_config.file_path")
    wanted = config.where(~is_blank(path)).select("canonical_key", F.col("id").alias("source_id"), path.alias("path"), file_format(path, F.col("fetch_config.file_format")).alias("format"))
    wanted = stage(wanted.where(F.col("format").isin(FORMATS)), "imports")
    found, failures, missing = None, wanted.select("canonical_key", F.lit("").alias("message")).limit(0), []
    for kind in FORMATS:
        asked = sorted({r["path"] for r in wanted.where(F.col("format") == kind).select("path").collect()})
        paths = [p for p in asked if _is_there(spark, p)]
        missing += [p for p in asked if p not in paths]
        if not paths:
            continue
        records, rejected = read_json(spark, paths) if kind == "json" else (read_csv(spark, paths), None)
        own = records.withColumns({name: F.lit(None).cast("string") for name in ("record",) if name not in records.columns})
        own = own.select("position", "record", *RECORD_FIELDS).withColumn("path", _plain_path(F.col("position.file_path")))
        part = lookup_join(own.withColumn("pos", F.col("position.number")), wanted.select("source_id", _plain_path(F.col("path")).alias("path")), "path", "pos", "inner").drop("position", "path")
        found = part if found is None else found.unionByName(part)
        if rejected is not None:
            names = wanted.select("canonical_key", _plain_path(F.col("path")).alias("path"))
            failures = failures.union(rejected.select(_plain_path(F.col("file_path")).alias("path"), "message").join(names, "path").select("canonical_key", "message"))
    if missing:
        gone = spark.createDataFrame([(p,) for p in missing], "path string")
        failures = failures.union(wanted.join(gone, "path").select("canonical_key", F.lit("no import file").alias("message")))
    return found, failures


def _is_there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def strict_records(records: DataFrame) -> DataFrame:
    """Only records whose text fields are JSON text: a number in a text field drops the record."""
    variant = F.try_parse_json("record")
    fine = F.lit(True)
    for name in ("external_content_id", "id", "title", "raw_text", "content", "text", "url", "author_name", "author"):
        kind = F.schema_of_variant(F.try_variant_get(variant, f"$.{name}", "variant"))
        fine = fine & F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))
    return records.where(fine)


def manual_items(records: DataFrame, keep: list[str]) -> DataFrame:
    """Records to raw items; columns the records lack count as NULL."""
    have = set(records.columns)

    def first(*names: str) -> Column:
        given = [or_null(F.col(name)) for name in names if name in have]
        return F.coalesce(*given) if given else F.lit(None).cast("string")

    def plain(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    whole = F.to_json(F.struct(*[name for name in records.columns if name in RECORD_FIELDS]))
    if "record" in have:
        whole = F.coalesce("record", whole)
    return to_raw_items(
        records,
        keep,
        external_content_id=first("external_content_id", "id"),
        source_content_type=F.lit("manual"),
        title=plain("title"),
        raw_text=first("raw_text", "content", "text"),
        url=plain("url"),
        author_name=first("author_name", "author"),
        published_at=parse_datetime(first("published_at", "date"), fetched_at(records)),
        raw_payload=F.concat(F.lit('{"source_record":'), whole, F.lit("}")),
        **{name: strict_int(plain(name)) for name in ENGAGEMENT_COLUMNS},
    )


__all__ = ["FORMATS", "file_format", "manual_items", "payload", "read_csv", "read_import", "read_json", "read_source_imports", "strict_records"]
