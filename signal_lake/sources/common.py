"""The raw item schema all connectors project to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.schemas import RAW_ITEMS


def to_raw_items(records: DataFrame, keep: list[str], **columns: Column | str) -> DataFrame:
    """Project to ``keep`` and the raw item columns; a column not given is NULL of its type."""
    given = {name: F.col(value) if isinstance(value, str) else value for name, value in columns.items()}
    fields = [
        given.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in RAW_ITEMS.fields
        if field.name not in keep
    ]
    return records.select(*keep, *fields)


def payload(*columns: Column | str) -> Column:
    """The record as JSON text, fields without a value included as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


#: Column of landed records that says when they were fetched; a run sets it to its own time.
FETCHED = "_fetched_at"


def fetched_at(records: DataFrame) -> Column | None:
    """When each record was fetched, None if the records don't say."""
    return F.col(FETCHED) if FETCHED in records.columns else None


def file_position() -> list[Column]:
    """Order of records within a read: file, block of the file, place in the block."""
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("place"),
    ]
