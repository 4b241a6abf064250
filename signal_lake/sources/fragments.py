"""Large CSV, JSON and feed files read by all tasks: records are found from the state at the start of each piece.

A file is read in fragments that end at a character, whatever stands around it, so Spark can split it anywhere. Whether a fragment begins inside
a quoted text, and how deep, follows from sums over the fragments before it: each block of a file is summed on its own, the sums of blocks (a
row each) are added up along the file, and fragments add what stands before them in their block. Only the pieces of one record meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from signal_lake.operators.skew import lookup_join
from signal_lake.session import stage
from signal_lake.sources.common import file_position

BLOCK = ["file_path", "block_start"]


def read_fragments(spark: SparkSession, path: str | list[str], end: str) -> DataFrame:
    """Staged rows (value, file_path, block_start, place): the pieces of the files between ``end`` characters, in order of (block_start, place)."""
    return stage(spark.read.option("lineSep", end).text(path).select("value", *file_position()), "fragments")


def with_sum_before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over all earlier fragments of the file."""
    valued = rows.withColumn("_value", value.cast("bigint"))
    sums = valued.groupBy(*BLOCK).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*BLOCK, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = valued.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return numbered.join(starts, BLOCK).withColumn(name, F.col("_start") + F.col("_inside")).drop("_value", "_start", "_inside")


def with_last_before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the last ``value`` that isn't NULL of all earlier fragments of the file, false if there is none."""
    valued = rows.withColumn("_value", value.cast("boolean"))
    lasts = valued.groupBy(*BLOCK).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("place"))).alias("_last"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = lasts.select(*BLOCK, F.coalesce(F.last("_last", True).over(earlier), F.lit(False)).alias("_start"))
    inside = Window.partitionBy(*BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    told = valued.withColumn("_inside", F.last("_value", True).over(inside))
    return told.join(starts, BLOCK).withColumn(name, F.coalesce("_inside", "_start")).drop("_value", "_start", "_inside")


def joined(rows: DataFrame, between: str) -> Column:
    """The values of a group's fragments put together in their order."""
    pieces = F.array_sort(F.collect_list(F.struct("block_start", "place", "value")))
    return F.array_join(F.transform(pieces, lambda p: p["value"]), between)


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, number, text) of every CSV record, the header of a file included; ``number`` rises along the file.

    Lines end with a line feed, with or without a carriage return. A record of one line stays where it was read; the lines of a longer one,
    those between quotes, are put together.
    """
    lines = read_fragments(spark, path, "\n").withColumn("odd", F.regexp_count("value", F.lit('"')) % 2)
    opened = with_sum_before(lines, F.col("odd"), "quotes").withColumn("starts", (F.col("quotes") % 2 == 0).cast("int"))
    counted = with_sum_before(opened, F.col("starts"), "earlier").withColumn("number", F.col("earlier") + F.col("starts"))
    counted = stage(counted.select(*BLOCK, "place", "number", "value", ((F.col("starts") == 1) & (F.col("odd") == 0)).alias("alone")), "lines")
    single = counted.where("alone").select("file_path", "number", F.col("value").alias("text"))
    longer = counted.where("NOT alone").groupBy("file_path", "number").agg(joined(counted, "\n").alias("text"))
    whole = single.unionByName(longer).withColumn("text", F.regexp_replace("text", r"\r\z", ""))
    return whole.where(F.trim("text") != "")


def csv_fields(spark: SparkSession, path: str | list[str], names: Sequence[str]) -> DataFrame:
    """(position, header, ``names`` ...): fields of every record by the names in the header of its file, NULL where that lacks one.

    All headers are one plan; only the greatest number of columns comes to the driver.
    """
    records = stage(csv_records(spark, path), "csv_records")
    heads = stage(records.groupBy("file_path").agg(F.min("number").alias("first"), F.min_by("text", "number").alias("head")), "headers")
    width = heads.agg(F.max(F.regexp_count("head", F.lit(",")) + 1)).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(width))

    def cells(text: Column) -> Column:
        parsed = F.from_csv(text, F.lit(schema), {"escape": '"'})
        return F.array(*[parsed[f"c{i}"] for i in range(width)])

    named = heads.select("file_path", "first", cells(F.regexp_replace("head", r"\A\x{FEFF}", "")).alias("header"))
    body = lookup_join(records, named, "file_path", "number", "inner").where("number > first").select("file_path", "number", "header", cells(F.col("text")).alias("cells"))

    def field(name: str) -> Column:
        at = F.array_position("header", name).cast("int")
        return F.when(at > 0, F.get("cells", at - 1)).alias(name)

    return body.select(F.struct("file_path", "number").alias("position"), "header", *[field(n) for n in names])


def _depth(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[{\[]")) - F.regexp_count(text, F.lit(r"[}\]]"))


def _every_other(segments: Column, first: int) -> Column:
    return F.array_join(F.filter(segments, lambda s, i: i % 2 == first), " ")


def json_entries(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(file_path, number, record) of the objects in the lists that files hold, and the files (file_path) that hold no list.

    Fragments end at closing braces. Behind one that brings the depth back to that of the list, a record ends; what stands between
    two of those, entries that are no objects, is parsed with the record that follows, and only that, the last one, is kept.
    """
    pieces = read_fragments(spark, path, "}")
    segments = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    outside = [_every_other(segments, k) for k in (0, 1)]
    measured = pieces.withColumns({"quotes": F.size(segments) - 1, "d0": _depth(outside[0]), "d1": _depth(outside[1])})
    measured = with_sum_before(measured, F.col("quotes"), "before")
    closes = (F.col("before") + F.col("quotes")) % 2 == 0
    step = F.when(F.col("before") % 2 == 0, F.col("d0")).otherwise(F.col("d1")) - closes.cast("int")
    measured = with_sum_before(measured.withColumn("step", step).withColumn("closes", closes), F.col("step"), "depth")
    measured = measured.withColumn("ends", F.col("closes") & (F.col("depth") + F.col("step") == 1))
    counted = with_sum_before(measured, F.col("ends").cast("int"), "number")
    counted = stage(counted.select(*BLOCK, "place", "number", "value", "ends", "step", "quotes"), "pieces")
    whole = counted.groupBy("file_path", "number").agg(joined(counted, "}").alias("text"), F.max("ends").alias("ends")).where("ends")
    lead = F.when(F.col("number") == 0, F.regexp_replace("text", r"\A[\x{FEFF}\s]*\[", "")).otherwise(F.regexp_replace("text", r"\A\s*,", ""))
    parsed = whole.select("file_path", "number", F.from_json(F.concat(F.lit("["), lead, F.lit("}]")), "array<string>").alias("entries"))
    parsed = stage(parsed, "entries")
    # A list closes what it opens; the end of a file counts as one more brace. Spark passes over files of no byte.
    first = F.min_by("value", F.struct("block_start", "place"))
    files = counted.groupBy("file_path").agg(first.rlike(r"\A[\x{FEFF}\s]*\[").alias("list"), F.sum("step").alias("steps"), F.sum("quotes").alias("quotes"))
    bad = files.where(~F.col("list") | (F.col("steps") != -1) | (F.col("quotes") % 2 != 0)).select("file_path")
    rejected = stage(bad.union(parsed.where("entries IS NULL").select("file_path")).distinct(), "rejected")
    fine = parsed.join(rejected, "file_path", "left_anti")
    return fine.select("file_path", "number", F.element_at("entries", -1).alias("record")), rejected
