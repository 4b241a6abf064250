"""Ingestion of a landing folder that keeps growing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signal_lake.operators.dedup import KEY
from signal_lake.operators.index import StoredIndex
from signal_lake.operators.late import settle
from signal_lake.plans.ingest import fingerprints, outcomes_of, turned_away
from signal_lake.session import stage

OUTCOMES = (
    "arrival bigint, source_id string, external_content_id string, content_hash string, inserted boolean, is_duplicate boolean, outcome string, reason string"
)

_NAMES = [field.split()[0] for field in OUTCOMES.split(", ")]


def complete_drains(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the drains that came to their end, one row of the ledger each."""
    done = _read_or_none(spark, f"{root}/drained", "drain int")
    return [] if done is None else sorted(row["drain"] for row in done.select("drain").collect())


def land_fingerprints(
    spark: SparkSession, landing: str, schema: T.StructType, root: str,
    to_items: Callable[[DataFrame], DataFrame] = lambda rows: rows, files_per_batch: int = 1000,
) -> None:
    """Stream the files not seen yet through cleaning into the partition of the next drain, each exactly once.

    ``landing`` is a folder of files, of any names. ``to_items`` turns landed rows into items with ``arrival``; the stream ends when all is
    drained. Which files were seen is the stream's own checkpoint; which fingerprints belong to a drain is the partition they are in.
    """
    number = len(complete_drains(spark, root))
    landed = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    query = (
        fingerprints(to_items(landed))
        .withColumn("drain", F.lit(number))
        .writeStream.format("parquet")
        .partitionBy("drain")
        .option("path", f"{root}/fingerprints")
        .option("checkpointLocation", f"{root}/fingerprints_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def dedup_landed(spark: SparkSession, root: str, exact: bool = False) -> DataFrame:
    """Mark every streamed row that has no outcome yet and write the outcomes of this drain.

    Rows of one drain are marked in the order of ``arrival``, whatever they are, and against all rows that earlier drains stored, which are looked
    up in an index. A row that comes late counts as later than those. With ``exact`` it takes its place among them: groups it touches are
    opened again, and corrections of earlier outcomes are written beside them, so that drains in any order end in the result
    of one batch (``current_outcomes``). The ledger row is written last; a drain that breaks off before
    is done again under the same number. A folder is drained in one way throughout.
    """
    done = complete_drains(spark, root)
    number = len(done)
    landed = _read_or_none(spark, f"{root}/fingerprints")
    index = StoredIndex(spark, f"{root}/index", tuple(done))
    path = f"{root}/outcomes/drain={number}"
    rows = None if landed is None else landed.where(F.col("drain") == number)
    if rows is None or rows.isEmpty():
        return spark.createDataFrame([], OUTCOMES)
    prints = stage(rows.select("arrival", *KEY, "content_hash", "reason"), "fingerprints")
    if exact:
        fine = stage(prints.where("reason IS NULL AND content_hash IS NOT NULL").drop("reason"), "fine")
        marked = settle(fine, index).drop("fresh").unionByName(turned_away(prints))
    else:
        marked = outcomes_of(prints, index)
    marked.select(*_NAMES).write.mode("overwrite").parquet(path)
    marked = spark.read.schema(OUTCOMES).parquet(path)
    if exact:
        index.add_members(fine, "arrival", number)
    else:
        index.add(marked.where("inserted"), number)
    ledger = spark.createDataFrame([(marked.count(),)], "rows bigint")
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{root}/drained/drain={number}")
    return marked


def all_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Outcomes of all complete drains, corrections included."""
    paths = [f"{root}/outcomes/drain={number}" for number in complete_drains(spark, root)]
    return spark.read.schema(OUTCOMES).parquet(*paths) if paths else spark.createDataFrame([], OUTCOMES)


def current_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """The last outcome of every row."""
    paths = [f"{root}/outcomes/drain={number}" for number in complete_drains(spark, root)]
    if not paths:
        return spark.createDataFrame([], OUTCOMES)
    whole = spark.read.schema(f"{OUTCOMES}, drain int").option("basePath", f"{root}/outcomes").parquet(*paths)
    names = [name for name in whole.columns if name != "drain"]
    return whole.groupBy("arrival").agg(F.max_by(F.struct(*names), "drain").alias("_last")).select("_last.*")


def distinct_within(items: DataFrame, time: str, delay: str) -> DataFrame:
    """The weaker form that lives in the stream alone: drops repeats within the watermark instead of flagging them."""
    return items.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except Exception as error:  # the first round has nothing yet, nor has a drain of no files
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
