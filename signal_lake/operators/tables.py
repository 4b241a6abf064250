"""Table updates as joins: each takes the stored rows and the change, and returns the new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.operators.skew import keep_first, lookup_join
from signal_lake.schemas import CONTENT_STATUSES, FETCH_METHODS, SCORE_COLUMNS, SOURCE_SEED, SOURCES

KEY = "canonical_key"
_OVERWRITTEN = [name for name in SOURCE_SEED.names if name != KEY]


def source_id(canonical_key: Column) -> Column:
    """Id of a source, derived from its key so that every run gives the same one."""
    return F.sha2(canonical_key, 256)


def new_sources(seed: DataFrame, run_at: Column) -> DataFrame:
    """Rows of the ``sources`` table for seeds not stored yet."""
    fresh = seed.select(
        source_id(F.col(KEY)).alias("id"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCE_SEED.fields],
        F.lit(0).alias("error_count"),
        F.lit(None).cast("timestamp").alias("last_error_at"),
        F.lit(None).cast("string").alias("last_error_msg"),
        F.lit(None).cast("timestamp").alias("last_checked_at"),
        run_at.alias("created_at"),
        run_at.alias("updated_at"),
    )
    return fresh.select(*SOURCES.names)


def upsert_sources(stored: DataFrame, seed: DataFrame, run_at: Column) -> DataFrame:
    """Insert new keys; overwrite the described columns of known ones and keep id, state and creation time."""
    fresh = new_sources(seed, run_at).select(F.struct(*SOURCES.names).alias("new"), KEY)
    old = stored.select(F.struct(*SOURCES.names).alias("old"), KEY)
    both = old.join(fresh, KEY, "full_outer")
    in_new, in_old = F.col("new").isNotNull(), F.col("old").isNotNull()

    def merged(name: str) -> Column:
        taken = name in _OVERWRITTEN
        if name == KEY:
            return F.col(KEY)
        if taken or name == "updated_at":
            return F.when(in_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
        return F.when(in_old, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}")).alias(name)

    return both.select(*[merged(name) for name in SOURCES.names])


def record_state(sources: DataFrame, errors: DataFrame, checked: DataFrame, run_at: Column) -> DataFrame:
    """Count errors and note the last one (``errors``: canonical_key, message, seq); touch ``checked`` keys.

    The counter is never reset, a failed fetch does not count as checked.
    """
    noted = errors.groupBy(KEY).agg(F.count("*").alias("_errors"), F.max_by("message", "seq").alias("_message"))
    touched = checked.select(KEY).distinct().withColumn("_checked", F.lit(True))
    joined = sources.join(noted, KEY, "left").join(touched, KEY, "left")
    failed, seen = F.col("_errors").isNotNull(), F.col("_checked").isNotNull()
    return joined.select(
        *[
            {
                "error_count": (F.col("error_count") + F.coalesce("_errors", F.lit(0))).cast("int").alias("error_count"),
                "last_error_at": F.when(failed, run_at).otherwise(F.col("last_error_at")).alias("last_error_at"),
                "last_error_msg": F.coalesce("_message", "last_error_msg").alias("last_error_msg"),
                "last_checked_at": F.when(seen, run_at).otherwise(F.col("last_checked_at")).alias("last_checked_at"),
                "updated_at": F.when(failed | seen, run_at).otherwise(F.col("updated_at")).alias("updated_at"),
            }.get(name, F.col(name))
            for name in sources.columns
        ]
    )


def update_status(items: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Set the status of the items named in ``changes`` (key, status, seq), the last change of an item winning."""
    last = changes.groupBy(key).agg(F.max_by("status", "seq").alias("_status"))
    updated = items.join(last, key, "left").withColumn("status", F.coalesce("_status", "status"))
    return updated.select(*items.columns)


def cascade_delete(items: DataFrame, removed: DataFrame, spread: str) -> DataFrame:
    """Items without those of ``removed`` sources (column source_id)."""
    gone = removed.select("source_id").distinct()
    return lookup_join(items, gone, "source_id", spread, "left_anti")


def violations(sources: DataFrame) -> Column:
    """Names of the table constraints a source row breaks, an empty array if none."""

    def unless(name: str, broken: Column) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.lit(name))

    checks = [unless(f"{name}_missing", F.col(name).isNull())
              for name in ("source_name", "canonical_name", "canonical_key", "source_type")]
    checks += [unless(f"{name}_range", ~F.col(name).between(1, 5)) for name in SCORE_COLUMNS]
    checks += [unless(f"{name}_range", F.col(name).isNull() | ~F.col(name).between(1, 3)) for name in ("tier", "wave")]
    checks.append(unless("fetch_method_unknown", F.col("fetch_method").isNull() | ~F.col("fetch_method").isin(FETCH_METHODS)))
    return F.array_compact(F.array(*checks))


def item_violations() -> Column:
    """The same for an item row: required columns and a known status."""
    checks = [F.when(F.col(name).isNull(), F.lit(f"{name}_missing")) for name in ("source_id", "content_hash")]
    checks.append(F.when(F.col("status").isNull() | ~F.col("status").isin(CONTENT_STATUSES), F.lit("status_unknown")))
    return F.array_compact(F.array(*checks))


def split_quarantine(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows with their ``violations``): bad rows never stop the good ones."""
    checked = sources.withColumn("violations", violations(sources))
    return (
        checked.where(F.size("violations") == 0).drop("violations"),
        checked.where(F.size("violations") > 0),
    )


__all__ = [
    "cascade_delete", "item_violations", "keep_first", "new_sources", "record_state", "source_id",
    "split_quarantine", "update_status", "upsert_sources", "violations",
]
