"""Feed files of any size, read by all tasks: each entry is parsed on its own, with the root element of its file around it.

A file is read in fragments that end at ``>``. Whether one begins in a CDATA section, a comment or an entry follows from the last fragment
before it that opens or closes one (``fragments.with_last_before``), so no task needs more of a file than its block, and no more than
the fragments of one entry meet.

Results for odd files: a file that breaks off keeps its whole entries; an entry that doesn't parse is an error of its own and costs no
other. A file that is no feed, or that yields no entry although it holds some or isn't closed, is an error. What stands in comments and CDATA
sections is no entry. A comment must close the CDATA sections it opens. Files without a byte give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signal_lake.operators.skew import lookup_join
from signal_lake.session import stage
from signal_lake.sources.feeds import ATOM_NAMES, RSS_NAMES, feed_entries, own_prefix
from signal_lake.sources.fragments import BLOCK, joined, read_fragments, with_last_before, with_sum_before

_DATA, _COMMENT = "<![CDATA[", "<!--"


def _marked(pieces: DataFrame) -> DataFrame:
    """Fragments with ``tag``, the element's tag that a fragment ends with, outside CDATA sections and comments; else NULL."""
    opens = F.contains("value", F.lit(_DATA))
    data = F.when(F.endswith("value", F.lit("]]")), False).when(opens, True)
    rows = with_last_before(pieces, data, "in_data")
    rows = rows.withColumn("data_after", F.coalesce(data, F.col("in_data")))
    before_data = F.call_function("substring_index", F.col("value"), F.lit(_DATA), F.lit(1))
    comment = F.when(F.col("in_data"), None).when(F.endswith("value", F.lit("--")) & ~F.col("data_after"), False).when(F.contains(before_data, F.lit(_COMMENT)), True)
    rows = with_last_before(rows, comment, "in_comment")
    plain = ~F.col("in_data") & ~F.col("data_after") & ~F.col("in_comment") & comment.isNull()
    tag = F.regexp_extract("value", r"(?s)(</?[^\s<>!?/][^<]*)\z", 1)
    return rows.withColumn("tag", F.when(plain & (tag != ""), tag)).drop("in_data", "data_after", "in_comment")


def _name(tag: Column) -> Column:
    return F.regexp_extract(tag, r"\A</?([^\s/]+)", 1)


def _roots(rows: DataFrame) -> DataFrame:
    """A row per file: its root element's tag and name, kind, the names its entries have, and whether its last tag closes the root."""
    at = F.struct("block_start", "place")
    tagged = F.col("tag").isNotNull()
    files = rows.groupBy("file_path").agg(
        F.min_by(F.when(tagged, F.col("tag")), F.when(tagged, at)).alias("root"),
        F.max_by(F.when(tagged, F.col("tag")), F.when(tagged, at)).alias("last"),
    )
    name = _name(F.coalesce("root", F.lit("")))
    local = F.regexp_replace("root_name", "^.*:", "")
    files = files.withColumn("root_name", name)
    files = files.withColumn("kind", F.when(local == "feed", "atom").when(local.isin("rss", "RDF", "channel"), "rss").otherwise("none"))
    atom = F.col("kind") == "atom"
    entry = F.when(atom, "entry").otherwise("item")
    prefix = F.when(atom, own_prefix(F.col("root"), ATOM_NAMES)).otherwise(own_prefix(F.col("root"), RSS_NAMES))
    closed = F.col("last").startswith("</") & (_name(F.col("last")) == F.col("root_name")) | F.col("last").endswith("/") & (F.col("last") == F.col("root"))
    return files.select(
        "file_path", "root", "root_name", "kind", closed.alias("closed"),
        F.when(F.col("kind") != "none", F.array(entry, F.concat(prefix, F.when(prefix != "", ":").otherwise(""), entry))).alias("names"),
    )


def dump_entries(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(entries of the files with ``file_path`` and ``pos``, errors as ``file_path``, ``pos`` and ``message``); ``pos`` of a whole file's error is NULL."""
    rows = stage(_marked(read_fragments(spark, path, ">")), "feed_tags")
    roots = stage(_roots(rows), "feed_roots")
    named = lookup_join(rows, roots.select("file_path", "names"), "file_path", "place")
    is_entry = F.coalesce(F.array_contains("names", _name(F.col("tag"))), F.lit(False))
    begins = is_entry & ~F.col("tag").startswith("</")
    alone = F.col("tag").endswith("/")
    state = named.select(
        *BLOCK, "place", F.when(begins, F.col("tag")).otherwise(F.col("value")).alias("value"),
        begins.alias("begins"), (is_entry & (F.col("tag").startswith("</") | alone)).alias("ends"),
    )
    counted = with_sum_before(state, F.col("begins").cast("int"), "earlier")
    counted = with_last_before(counted, F.when(F.col("ends"), False).when(F.col("begins"), True), "inside")
    counted = counted.withColumn("number", F.col("earlier") + F.col("begins").cast("int")).where("begins OR inside")
    texts = counted.groupBy("file_path", "number").agg(joined(counted, ">").alias("text"), F.max("ends").alias("whole")).where("whole")
    texts = stage(texts.select("file_path", (F.col("number") - 1).alias("pos"), "text"), "feed_entries")

    rss = F.lower(F.regexp_replace("root_name", "^.*:", "")) == "rss"
    open_, close = F.when(rss, "<channel>").otherwise(""), F.when(rss, "</channel>").otherwise("")
    around = lookup_join(texts, roots.select("file_path", "root", "root_name"), "file_path", "pos", "inner")
    single = around.select("file_path", "pos", F.concat("root", F.lit(">"), open_, "text", F.lit(">"), close, F.lit("</"), "root_name", F.lit(">")).alias("xml"))
    entries, failed = feed_entries(single.withColumnRenamed("pos", "number"), ["file_path", "number"])
    entries = stage(entries.drop("pos").withColumnRenamed("number", "pos"), "feed_parsed")
    kept = entries.groupBy("file_path").agg(F.count("*").alias("n"))
    began = state.where("begins").groupBy("file_path").agg(F.count("*").alias("m"))
    files = roots.join(kept, "file_path", "left").join(began, "file_path", "left").where("n IS NULL")
    lost = files.where((F.col("kind") == "none") | F.col("m").isNotNull() | ~F.coalesce("closed", F.lit(False)))
    message = F.lit("feed parse error").alias("message")
    errors = failed.select("file_path", F.col("number").alias("pos"), F.lit("entry parse error").alias("message"))
    return entries, errors.unionByName(lost.select("file_path", F.lit(None).cast("bigint").alias("pos"), message))
