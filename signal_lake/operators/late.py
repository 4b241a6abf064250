"""The dedup result kept right while rows come in any order.

Every row has a place in one order. A row that comes late may take a key from the row that held it so far, and a fingerprint that becomes or
stops being the first one of an inserted row changes the mark of the rows after it. So a batch re-opens the groups it touches, and those
only: the keys of its rows, the fingerprints of its rows and of the rows that lost their key. The outcomes of these groups are worked out twice,
without and with the batch, and rows whose outcome differs are corrections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signal_lake.operators.dedup import KEY
from signal_lake.operators.index import StoredIndex, entries_of
from signal_lake.operators.skew import large_lookup_join, with_group_min
from signal_lake.session import stage


def _firsts(rows: DataFrame) -> DataFrame:
    """By key, the first row of all and the first of the old ones, with the fingerprint of the latter."""
    old = F.when(~F.col("fresh"), F.col("member"))
    keyed = rows.where(F.col("external_content_id").isNotNull() & F.col("source_id").isNotNull())
    return keyed.groupBy(*KEY).agg(F.min("member").alias("first"), F.min(old).alias("old_first"), F.min_by("content_hash", old).alias("old_print"))


def settle(batch: DataFrame, index: StoredIndex, order: str = "arrival") -> DataFrame:
    """Rows of the batch with their outcome, and stored rows with one that the batch changed (``fresh`` false).

    ``batch`` is narrow and staged: ``order``, the two key columns and ``content_hash``, none of them NULL but an external id; ``index`` holds
    all rows so far as members.
    """
    missing = F.lit(None).cast("string")
    columns = [*KEY, "content_hash", "member"]
    fresh = batch.select(*KEY, "content_hash", F.col(order).cast("bigint").alias("member"), F.lit(True).alias("fresh"))

    def stored(asked: DataFrame, name: str) -> DataFrame:
        return stage(index.members(stage(asked, name)).select(*columns, F.lit(False).alias("fresh")), name)

    def by_key(rows: DataFrame) -> DataFrame:
        return entries_of(rows.select(*KEY, missing.alias("content_hash")))

    firsts = _firsts(fresh.union(stored(by_key(fresh), "key_members")))
    lost = firsts.where(F.col("old_first") > F.col("first")).select(F.col("old_print").alias("content_hash"))
    prints = fresh.select("content_hash").union(lost).distinct()
    opened = entries_of(prints.select(missing.alias("source_id"), missing.alias("external_content_id"), "content_hash"))
    members = stage(fresh.union(stored(opened, "print_members")), "members")

    # Whether a member is inserted depends on its key, which may have rows outside the opened fingerprints. There are about as many keys as members.
    keys = members.select(*KEY).where(F.col("external_content_id").isNotNull() & F.col("source_id").isNotNull()).distinct()
    of_keys = _firsts(fresh.union(stored(by_key(keys), "member_keys")))
    table = of_keys.select(F.struct(*KEY).alias("_key"), "first", "old_first")
    known = large_lookup_join(members.withColumn("_key", F.struct(*KEY)), table, "_key", "member", "left").drop("_key")
    free = F.col("external_content_id").isNull()
    known = known.withColumn("inserted", free | F.coalesce(F.col("member") == F.col("first"), F.lit(False)))
    known = known.withColumn("was_inserted", ~F.col("fresh") & (free | F.coalesce(F.col("member") == F.col("old_first"), F.lit(False))))
    known = stage(known.drop("first", "old_first"), "known")
    marked = with_group_min(known, ["content_hash"], "member", "_first", counted=F.col("inserted"))
    marked = with_group_min(marked, ["content_hash"], "member", "_old_first", counted=F.col("was_inserted"))
    marked = marked.withColumn("is_duplicate", F.coalesce(F.col("_first") < F.col("member"), F.lit(False)))
    was_duplicate = F.coalesce(F.col("_old_first") < F.col("member"), F.lit(False))
    changed = marked.where(F.col("fresh") | (F.col("inserted") != F.col("was_inserted")) | (F.col("is_duplicate") != was_duplicate))
    lost_key = ~F.col("is_duplicate") & ~F.col("inserted")
    outcome = F.when(F.col("is_duplicate"), "duplicate").when(F.col("inserted"), "saved").otherwise("skipped")
    return changed.select(
        F.col("member").alias(order), *KEY, "content_hash", "inserted", "is_duplicate", outcome.alias("outcome"), F.when(lost_key, "key_conflict").alias("reason"), "fresh"
    )
