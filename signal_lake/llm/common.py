"""What several operators of this package share: task settings, words, ranks over all rows, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from signal_lake.session import stage

#: Rows and bytes of one Arrow batch: what a Python worker holds at a time stays small even if texts are long.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and let Python workers import this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_column(column: Column | str) -> Column:
    return F.col(f"`{column}`") if isinstance(column, str) else column


def schema_of(rows: DataFrame, kept: Sequence[str], fields: str) -> StructType:
    """The fields of ``rows`` named by ``kept``, then those of the DDL ``fields``."""
    return StructType([*(StructField(name, rows.schema[name].dataType) for name in kept), *StructType.fromDDL(fields).fields])


def map_batches(rows: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """``function`` over every Arrow batch of ``rows``; empty batches are passed over."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return rows.mapInArrow(each, schema)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8; ``bytes.split`` and ``bytes.lower`` know exactly these blanks and A-Z."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def with_rank(
    rows: DataFrame, keys: Sequence[str], order: str, name: str, blocks: int, weight: Column | None = None
) -> DataFrame:
    """Add to each row the rows (or their ``weight``) that stand before it in its group.

    Groups may hold any share of all rows: each is cut into ``blocks`` by a hash of ``order`` (unique in the
    rows), blocks are summed, the sums are added up over the blocks of a group, and rows are numbered within
    their block only. The order is that of (block, order): fixed, but not that of ``order`` itself.
    """
    keys = list(keys)
    cut = rows.withColumn("_block", F.pmod(F.xxhash64(order), F.lit(blocks)))
    size = F.lit(1) if weight is None else weight
    sums = cut.groupBy(*keys, "_block").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = cut.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = numbered.join(starts, [*keys, "_block"])
    return joined.withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint")).drop("_block", "_inside", "_start")


def lookup_salted(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: Sequence[str], salts: int = 64) -> DataFrame:
    """Rows with the columns of the row of ``table`` that has their ``keys`` (one row a key); rows without one are left out.

    A key may be that of any share of the rows: it is joined by (key, salt), the salt drawn from ``spread``, and its row in
    the table is repeated for just those salts that its rows have.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    used = salted.groupBy(*keys).agg(F.bit_or(F.expr("shiftleft(1L, CAST(_salt AS INT))")).alias("_salts"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    fanned = table.join(used, list(keys)).withColumn("_salt", F.explode(F.filter(every, lambda i: F.getbit(F.col("_salts"), i) == 1)))
    return salted.join(fanned.drop("_salts"), [*keys, "_salt"]).drop("_salt")


def blocks_for(count: int, rows: int = 50_000) -> int:
    """Blocks of about ``rows`` rows."""
    return max(8, -(-count // rows))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node.

    Each round takes the least label among a node and its neighbours, then the label of that label, so the
    distance to the least node halves. Every round is a written table, which cuts the lineage.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(both.where("a <> b").distinct(), "edges")
    labels = stage(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(rounds):
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lower = stage(lower, "labels")
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(
            lower.join(target, "label", "left").select("node", F.least("label", "next").alias("label"), "old"), "labels"
        )
        moved = labels.where("label <> old").limit(1).count()
        labels = labels.drop("old")
        if not moved:
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
