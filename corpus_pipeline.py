"""A corpus of documents from raw to packed: a stage each for language, quality, near copies and packing.

A stage takes (session, documents, folder) and returns a DataFrame. Each one's result is written as Parquet to the shared folder
and read again as the next one's documents, so a lost executor costs a re-read and memory holds no table. All
stages but the last return the columns of documents, whatever they are called; a document is carried
along as one struct, so columns may have the names that operators use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from signal_lake.llm import language_id, minhash_dedup, packing, quality_rules
from signal_lake.llm.common import prepare
from signal_lake.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document stays if its language is told with this probability, and its text fits that language.
LEAST_SCORE = 0.5


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from the labelled documents that are not held out."""
    found = language_id.identify(_whole(docs), F.col("doc.doc_id"), F.col("doc.text"), F.col("doc.lang"), check_fit=True)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands of their language."""
    judged = quality_rules.judge(_whole(docs), "doc", F.col("doc.text"), F.col("doc.lang"))
    return judged.where("kept").select("doc.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; the row's number tells equal ids apart."""
    rows = stage(_whole(docs).withColumn("row", F.monotonically_increasing_id()), "documents")
    found = minhash_dedup.near_duplicates(rows, F.struct(F.col("doc.doc_id").alias("doc_id"), "row"), F.col("doc.text"))
    kept = found.where("kept").select(F.col("id.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, "doc_id", "text")


STAGES: list[tuple[str, Stage]] = [("language", language), ("quality", quality), ("near_copies", near_copies), ("packing", pack)]
#: Language scores, token statistics and packing have no form in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
