"""A whole run against stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from signal_lake.operators import language as L, tables
from signal_lake.operators.index import StoredIndex
from signal_lake.operators.skew import global_rank, large_lookup_join
from signal_lake.plans import ingest as I
from signal_lake.plans.limits import pick_landed
from signal_lake.plans.registry import active_sources, processing_order, source_by_key
from signal_lake.schemas import CONTENT_ITEMS, SOURCES
from signal_lake.session import stage
from signal_lake.sources.channel import cursor
from signal_lake.sources.common import FETCHED
from signal_lake.sources.router import has_connector, route, source_errors


#: So many runs may have an index of their own before they are merged into one.
MERGE_AFTER = 16
LEDGER = "run bigint, version bigint, index_runs array<bigint>"
CURSORS = "source_id string, min_id bigint"
COUNTS = "lang string, place bigint, n bigint"


def read_sources(spark: SparkSession, root: str, version: int) -> DataFrame:
    """One version of the registry. A run reads one version and writes the next, never the one it reads."""
    return spark.read.schema(SOURCES).parquet(f"{root}/sources/version={version}")


def write_sources(rows: DataFrame, root: str, version: int, mode: str = "errorifexists") -> None:
    rows.select(*SOURCES.names).write.mode(mode).parquet(f"{root}/sources/version={version}")


def complete_runs(spark: SparkSession, root: str) -> list[Row]:
    """Runs that came to their end, in order, one small row each: what a run wrote counts from its row in the ledger on."""
    if not _exists(spark, f"{root}/ledger"):
        return []
    return sorted(spark.read.schema(LEDGER).parquet(f"{root}/ledger").collect(), key=lambda r: r["run"])


def _of_runs(spark: SparkSession, root: str, part: str, schema: T.StructType | str, runs: Sequence[int]) -> DataFrame:
    paths = [f"{root}/{part}/run={run}" for run in runs]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{part}").parquet(*paths).drop("run")


def read_items(spark: SparkSession, root: str) -> DataFrame:
    """Items of complete runs; the split by ``is_duplicate`` is a partition column, so a read of originals skips the copies."""
    return _of_runs(spark, root, "content_items", CONTENT_ITEMS, [r["run"] for r in complete_runs(spark, root)]).select(*CONTENT_ITEMS.names)


def write_items(rows: DataFrame, root: str, run: int) -> None:
    """The items of one run; a run that is done again replaces its own."""
    rows.select(*CONTENT_ITEMS.names).write.mode("overwrite").partitionBy("is_duplicate").parquet(f"{root}/content_items/run={run}")


def read_cursors(spark: SparkSession, root: str) -> DataFrame:
    """(source_id, min_id): the message each channel was read to, as of the last complete run."""
    return _of_runs(spark, root, "cursors", CURSORS, [r["run"] for r in complete_runs(spark, root)][-1:])


def _begin(spark: SparkSession, root: str, run: int, version: int | None) -> None:
    """Note that a run begins. Only a run that began before may find its version of the registry there."""
    started = f"{root}/started/run={run}"
    if version is not None and _exists(spark, f"{root}/sources/version={version}"):
        mine = _exists(spark, started) and spark.read.schema("version bigint").parquet(started).where(F.col("version") == version).count()
        if not mine:
            raise ValueError(f"version {version} of the sources is there already")
    spark.createDataFrame([(version,)], "version bigint").coalesce(1).write.mode("overwrite").parquet(started)


#: An item's place in a run is one number: its source's place, and in the lower bits its place in the source.
POSITION_BITS = 40


def select_sources(
    sources: DataFrame, method: str | None = None, wave: int | None = None, key: str | None = None
) -> DataFrame:
    """Sources of a run: all active ones, or one method, one wave, one key; an inactive key yields none."""
    chosen = active_sources(sources, method, wave)
    return chosen.where(F.col("canonical_key") == key) if key else chosen


def require_source(sources: DataFrame, key: str) -> None:
    """A run that names its source fails if there is none or it is switched off."""
    found = source_by_key(sources, key).select("problem").limit(1).collect()
    if not found:
        raise ValueError(f"no source has the key {key!r}")
    if found[0].problem:
        raise ValueError(f"source {key!r} is {found[0].problem}")


def placed_sources(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, their number in the order of the run."""
    return global_rank(sources, processing_order(), "place")


def ordered_items(items: DataFrame, placed: DataFrame, pos: str = "pos") -> DataFrame:
    """Items of ``placed_sources`` with ``arrival``, source language and method."""
    table = placed.select(F.col("id").alias("source_id"), "place", F.col("language").alias("source_language"), "fetch_method")
    joined = large_lookup_join(items.drop("fetch_method", "source_language"), table, "source_id", pos)
    arrival = F.col("place") * F.lit(1 << POSITION_BITS) + F.col(pos).cast("bigint")
    return joined.withColumn("arrival", arrival).drop("place")


def with_key(outcomes: DataFrame, placed: DataFrame) -> DataFrame:
    """Outcomes with the key of their source and the item's ``pos`` there."""
    split = outcomes.withColumns({"place": F.shiftright("arrival", POSITION_BITS), "pos": F.col("arrival") % F.lit(1 << POSITION_BITS)})
    return large_lookup_join(split, placed.select("place", "canonical_key"), "place", "arrival").drop("place")


def run_ingestion(
    spark: SparkSession,
    root: str,
    sources: DataFrame,
    landed: dict[str, DataFrame],
    run_at: Column,
    version: int | None = None,
    method: str | None = None,
    wave: int | None = None,
    key: str | None = None,
    dry_run: bool = False,
    profile: DataFrame | None = None,
    detect: bool = True,
    failures: DataFrame | None = None,
    run: int | None = None,
) -> DataFrame:
    """Ingest landed records (method -> table with source_id, pos and the connector's fields).

    Each source's limits, selectors and cursor are applied to its records first. A missing language is detected unless ``detect`` is off: by
    ``profile``, or by the trigrams of this run's texts and those counted in the runs before.
    Returns the counters per source. A source that cannot be fetched
    gives an error row and no items, and so does one in ``failures`` (canonical_key, message): what readers
    and parsers of its files turned away. Records of a method without a connector are left; their sources are errors.

    Unless it is a dry run, it writes under ``root``, in folders of the ``run`` (the next number if none is given): items, their index, cursors,
    trigram counts, counters, and the sources with their new state as ``version``. Its row in the ledger comes last, and only
    what ledgered runs wrote is ever read. So a run that broke off anywhere is done again under its number with the
    same result, and a complete one just returns its counters.
    """
    if key:
        require_source(sources, key)
    done = complete_runs(spark, root)
    number = run if run is not None else max((r["run"] for r in done), default=0) + 1
    if not dry_run:
        if number in [r["run"] for r in done]:
            return spark.read.parquet(f"{root}/results/run={number}")
        _begin(spark, root, number, version)
    chosen = select_sources(sources, method, wave, key)
    errors = source_errors(chosen)
    if failures is not None:
        failed = failures.groupBy("canonical_key").agg(F.min("message").alias("message"))
        failed = failed.join(chosen.select("canonical_key", "fetch_method"), "canonical_key").join(errors.select("canonical_key"), "canonical_key", "left_anti")
        errors = errors.unionByName(failed.withColumn("recorded", F.lit(True)))
    errors = stage(errors, "source_errors")
    fit = stage(placed_sources(chosen.join(errors.select("canonical_key"), "canonical_key", "left_anti")), "fit")
    cursors = read_cursors(spark, root)
    index = StoredIndex(spark, f"{root}/index", tuple(done[-1]["index_runs"]) if done else ())
    picked = {name: pick_landed(name, records, fit, cursors).withColumn(FETCHED, run_at) for name, records in landed.items() if has_connector(name)}
    if not picked:
        nothing = fit.select("canonical_key", F.lit("none").alias("outcome")).limit(0)
        results = stage(I.run_results(nothing, errors, "canonical_key", fit), "run_results")
    else:
        routed = ordered_items(stage(route(picked, ["source_id", "pos"]), "routed"), fit).drop("pos")
        items = stage(I.prepared(routed), "prepared")
        outcomes = stage(I.ingest(items, index), "outcomes")
        results = stage(I.run_results(with_key(outcomes, fit), errors, "canonical_key", fit), "run_results")
    if dry_run:
        return results

    counts = _of_runs(spark, root, "trigrams", COUNTS, [r["run"] for r in done][-1:])
    if picked:
        if detect and profile is None:
            counts = stage(L.add_counts(counts, I.language_counts(items)), "trigrams")
            profile = L.profile_of(counts)
        write_items(I.content_rows(items, outcomes, run_at, profile=profile, detect=detect, run=number), root, number)
        index.add(outcomes.where("inserted"), number)
    counts.select("lang", "place", "n").write.mode("overwrite").parquet(f"{root}/trigrams/run={number}")
    read_to = cursors
    if "telegram_api" in picked:
        heard = landed["telegram_api"].join(fit.select(F.col("id").alias("source_id")), "source_id", "left_semi")
        read_to = cursors.unionByName(cursor(heard, ["source_id"]))
    read_to.groupBy("source_id").agg(F.max("min_id").alias("min_id")).write.mode("overwrite").parquet(f"{root}/cursors/run={number}")
    results.write.mode("overwrite").parquet(f"{root}/results/run={number}")
    if version is not None:
        noted = errors.where("recorded").select("canonical_key", "message", F.lit(0).alias("seq"))
        write_sources(tables.record_state(sources, noted, fit.select("canonical_key"), run_at), root, version, "overwrite")
    _finish(spark, root, number, version, index, bool(picked))
    return spark.read.parquet(f"{root}/results/run={number}")


def _finish(spark: SparkSession, root: str, run: int, version: int | None, index: StoredIndex, added: bool) -> None:
    """Write the ledger row; many small indexes are merged first."""
    runs = (*index.runs, run) if added else index.runs
    if len(runs) > MERGE_AFTER:
        runs = StoredIndex(spark, index.root, runs).merge(-run).runs
    row = spark.createDataFrame([(run, version, list(runs))], LEDGER)
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/run={run}")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except Exception as error:  # a first run has no table yet
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
    return True
