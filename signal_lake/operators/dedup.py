"""Duplicate marking with the outcome of a one-by-one run, as set operations.

In order, an item is inserted unless its (source, external id) is taken; a NULL external id is never
taken. It is a duplicate if its fingerprint is stored, or an earlier *inserted* item of the batch has
it; an item the key check swallowed leaves no fingerprint behind. Duplicates are inserted as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signal_lake.operators.skew import SALTS, with_group_min
from signal_lake.session import stage

KEY = ["source_id", "external_content_id"]


def touched_rows(items: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored keys, stored hashes) a staged batch can meet at all.

    The store is filtered by the keys and hashes of the batch, one way for every size: Spark measures the staged
    batch, sends it to the store's tasks if that is cheap, and else joins both by shuffle, with a Bloom
    filter of the batch on the store's side where its settings call for one.
    """
    return (
        stored.select(*KEY).join(items.select(*KEY).distinct(), KEY, "left_semi"),
        stored.select("content_hash").join(items.select("content_hash").distinct(), "content_hash", "left_semi"),
    )


def mark_duplicates(
    items: DataFrame, order: str = "arrival", stored: tuple[DataFrame, DataFrame] | None = None, salts: int = SALTS
) -> DataFrame:
    """Add ``outcome`` (saved, duplicate, skipped), ``reason``, ``inserted`` and ``is_duplicate``.

    ``items`` needs ``order`` (unique), the two key columns and ``content_hash``, and should be a
    narrow, staged table, for it is read more than once; ``stored`` holds the stored keys and the stored hashes.
    """
    stored_keys, stored_hashes = stored or (None, None)
    keyed = with_group_min(items, KEY, order, "_first_key", stored=stored_keys, stored_name="_key_stored", salts=salts)
    free = F.lit(True) if stored is None else ~F.col("_key_stored")
    keyed = keyed.withColumn(
        "inserted", F.col("external_content_id").isNull() | ((F.col("_first_key") == F.col(order)) & free)
    ).drop("_first_key", "_key_stored")
    # The key pass feeds both the groups of the hash pass and the rows they go back to; written, it runs once.
    keyed = stage(keyed, "keyed")

    hashed = with_group_min(
        keyed, ["content_hash"], order, "_first_hash", counted=F.col("inserted"),
        stored=stored_hashes, stored_name="_hash_stored", salts=salts,
    )
    known = F.lit(False) if stored is None else F.col("_hash_stored")
    earlier = F.coalesce(F.col("_first_hash") < F.col(order), F.lit(False))
    flagged = hashed.withColumn("is_duplicate", known | earlier).drop("_first_hash", "_hash_stored")

    lost = ~F.col("is_duplicate") & ~F.col("inserted")
    outcome = F.when(F.col("is_duplicate"), "duplicate").when(F.col("inserted"), "saved").otherwise("skipped")
    return flagged.withColumn("outcome", outcome).withColumn("reason", F.when(lost, "key_conflict"))
