"""Changes of a stored, partitioned table that rewrite only the partitions they touch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from signal_lake.operators import tables
from signal_lake.session import stage


def change_partitions(stored: DataFrame, path: str, partitions: Sequence[str], keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``change`` to the partitions of the table at ``path`` that hold a row with one of ``keys``; returns these partitions.

    ``stored`` is the table as it is read, with its partition columns. A first pass reads only the key columns and names the partitions; their
    new rows are written aside and then put in their place, partition by partition. All other files stay as they are. A change that is done
    again over its own result must give the same, as deletes and last-one-wins updates do, so a broken one is simply repeated.
    """
    spark, by = stored.sparkSession, list(partitions)
    touched = stage(stored.join(keys.distinct(), keys.columns, "left_semi").select(*by).distinct(), "touched")
    whole = stored.join(touched, by, "left_semi")
    changed = stage(change(whole).select(*stored.columns), "changed")
    if touched.isEmpty():
        return touched
    # A partition that lost all its rows would not be written, so nothing would replace its files: it goes as a whole.
    emptied = touched.join(changed.select(*by).distinct(), by, "left_anti").collect()
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        changed.write.mode("overwrite").partitionBy(*by).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    for row in emptied:
        folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{name}={str(row[name]).lower() if isinstance(row[name], bool) else row[name]}" for name in by)]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched


def delete_sources(stored: DataFrame, path: str, partitions: Sequence[str], removed: DataFrame, spread: str) -> DataFrame:
    """Remove the items of ``removed`` sources (column source_id)."""
    return change_partitions(stored, path, partitions, removed.select("source_id"), lambda rows: tables.cascade_delete(rows, removed, spread))


def set_statuses(stored: DataFrame, path: str, partitions: Sequence[str], changes: DataFrame, key: str = "id") -> DataFrame:
    """Set the status of the items named in ``changes`` (key, status, seq), the last change of an item winning."""
    return change_partitions(stored, path, partitions, changes.select(key), lambda rows: tables.update_status(rows, changes, key))


def source_bucket(buckets: int):
    """Partition of an item by its source, so that what concerns a source touches one partition."""
    return F.pmod(F.xxhash64("source_id"), F.lit(buckets)).cast("int")
