"""Ingestion: raw items to outcomes and stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.functions import scalars as S
from signal_lake.functions.space import is_blank, or_null
from signal_lake.functions.text import clean_text
from signal_lake.operators import language as L
from signal_lake.operators.dedup import KEY, mark_duplicates, touched_rows
from signal_lake.operators.index import StoredIndex
from signal_lake.operators.skew import SALTS, lookup_join
from signal_lake.schemas import CONTENT_ITEMS, ENGAGEMENT_COLUMNS
from signal_lake.session import stage


def with_source(items: DataFrame, sources: DataFrame, spread: str, how: str = "inner", **columns: str) -> DataFrame:
    """Add source columns (new name=source column) to items by ``source_id``, the source's ``id``."""
    table = sources.select(F.col("id").alias("source_id"), *[F.col(old).alias(new) for new, old in columns.items()])
    return lookup_join(items, table, "source_id", spread, how)


def with_clean_text(items: DataFrame) -> DataFrame:
    """Add ``normalized_text`` ('' for none)."""
    return items.withColumn("normalized_text", clean_text(F.col("raw_text")))


PRINT = [*KEY, "content_hash", "reason"]


def prepared(items: DataFrame) -> DataFrame:
    """Items with ``normalized_text``, ``content_hash``, and the ``reason`` of an early skip: the one pass over the texts.

    The advert check reads the raw text and spares those rows the cleaning. The text is cleaned once;
    length and fingerprint share the result. Skipped rows get no fingerprint. Staged, the result serves dedup, which
    reads its narrow columns, and the stored rows alike.
    """
    own = [name for name in items.columns if name not in ("normalized_text", "content_hash", "reason")]
    advert = (F.col("fetch_method") == "telegram_api") & S.is_advert(F.col("raw_text"))
    cleaned = items.select(*own, advert.alias("_advert"), F.when(~advert, clean_text(F.col("raw_text"))).alias("normalized_text"))
    reason = (
        F.when(F.col("source_id").isNull(), "no_source")
        .when(F.col("_advert"), "ad")
        .when(S.is_short(F.col("normalized_text")), "short")
    )
    prints = S.content_hash(F.col("source_id"), F.col("url"), F.col("title"), F.col("normalized_text"))
    return cleaned.select(*own, "normalized_text", F.when(reason.isNull(), prints).alias("content_hash"), reason.alias("reason"))


def fingerprints(items: DataFrame, order: str = "arrival") -> DataFrame:
    """The narrow rows dedup works on: order, key, ``content_hash``, and the ``reason`` of an early skip."""
    return prepared(items).select(order, *PRINT)


def outcomes_of(
    prints: DataFrame, stored: DataFrame | StoredIndex | None = None, order: str = "arrival", salts: int = SALTS
) -> DataFrame:
    """Outcome of every row of staged ``fingerprints``; skipped rows register neither key nor fingerprint.

    ``stored`` is an index of the stored rows, or holds their key columns and ``content_hash``.
    """
    fine = prints.where(F.col("reason").isNull() & F.col("content_hash").isNotNull()).select(order, *KEY, "content_hash")
    if stored is None:
        touched = None
    else:
        touched = stored.touched(fine) if isinstance(stored, StoredIndex) else touched_rows(fine, stored)
    return mark_duplicates(fine, order, touched, salts).unionByName(turned_away(prints, order))


def turned_away(prints: DataFrame, order: str = "arrival") -> DataFrame:
    """Outcome of the rows that were skipped early, or have no source."""
    broken = F.col("reason") == "no_source"
    return prints.where(F.col("reason").isNotNull()).select(
        order, *KEY, "content_hash",
        F.lit(False).alias("inserted"), F.lit(False).alias("is_duplicate"),
        F.when(broken, "error").otherwise("skipped").alias("outcome"), "reason",
    )


def ingest(items: DataFrame, stored: DataFrame | StoredIndex | None = None, order: str = "arrival", salts: int = SALTS) -> DataFrame:
    """Outcome of each item: order, key, content_hash, inserted, is_duplicate, outcome, reason.

    Of staged ``prepared`` items the narrow columns are read; other items go through the text pass first, which
    leaves a narrow staged table. All shuffles move narrow rows.
    """
    ready = set(PRINT) <= set(items.columns)
    prints = items.select(order, *PRINT) if ready else stage(fingerprints(items, order), "fingerprints")
    return outcomes_of(prints, stored, order, salts)


def labelled_texts(cleaned: DataFrame) -> DataFrame:
    """Cleaned items whose source has one language."""
    return cleaned.where(~is_blank(F.col("source_language")) & (F.col("source_language") != "mixed"))


def language_counts(cleaned: DataFrame) -> DataFrame:
    """Trigram counts of the cleaned items whose source has one language; counts of several runs add up."""
    return L.count_trigrams(labelled_texts(cleaned), "normalized_text", "source_language")


def language_profile(cleaned: DataFrame) -> DataFrame:
    """A profile trained on the cleaned items whose source has one language."""
    return L.profile_of(language_counts(cleaned))


def fill_language(items: DataFrame, order: str, profile: DataFrame | None) -> DataFrame:
    """``language``: the source's if it has one, else the detected one of the cleaned text; without a profile only the former.

    Only texts of sources without a language go through detection, and only they are joined with its result.
    """
    own = or_null(F.col("source_language"))
    if profile is None:
        return items.withColumn("language", own)
    blank = is_blank(F.col("source_language"))
    known = items.where(~blank).withColumn("language", own)
    unknown = items.where(blank)
    found = L.detect(unknown.select(order, "normalized_text"), order, "normalized_text", profile)
    return known.unionByName(unknown.join(found, order, "left").withColumnRenamed("detected", "language"))


def normalized_items(items: DataFrame, order: str = "arrival", profile: DataFrame | None = None, detect: bool = True) -> DataFrame:
    """All columns normalisation derives, next to ``order`` and the item's own columns.

    A missing language is detected unless ``detect`` is off, by ``profile`` or by one trained on the items themselves.
    """
    cleaned = with_clean_text(items)
    if not detect:
        cleaned = fill_language(cleaned, order, None)
    else:
        cleaned = stage(cleaned, "cleaned")
        cleaned = fill_language(cleaned, order, language_profile(cleaned) if profile is None else profile)
    return cleaned.select(
        *[name for name in items.columns if name not in ("normalized_text", "language")],
        or_null(F.col("normalized_text")).alias("normalized_text"),
        S.content_hash(F.col("source_id"), F.col("url"), F.col("title"), F.col("normalized_text")).alias("content_hash"),
        S.content_type(F.col("source_content_type")).alias("content_type"),
        "language",
        F.lit("normalized").alias("status"),
    )


def content_rows(
    items: DataFrame, outcomes: DataFrame, run_at: Column, order: str = "arrival", profile: DataFrame | None = None, detect: bool = True,
    run: int | None = None,
) -> DataFrame:
    """Rows of ``content_items`` for the inserted items of a staged ``prepared`` table.

    A missing language is detected as in ``normalized_items``, on (order, text) rows of the staged table, before anything is joined: languages
    and outcomes meet as narrow rows, and the wide rows are shuffled once, on the unique ``order``. ``run`` is part of the ids if given.
    """
    taken = outcomes.where("inserted").select(order, "content_hash", "is_duplicate")
    if detect:
        known = language_profile(items) if profile is None else profile
        asked = items.where(F.col("reason").isNull() & is_blank(F.col("source_language"))).select(order, "normalized_text")
        taken = taken.join(L.detect(asked, order, "normalized_text", known), order, "left")
    else:
        taken = taken.withColumn("detected", F.lit(None).cast("string"))
    lacking = [f for f in CONTENT_ITEMS.fields if f.name in (*ENGAGEMENT_COLUMNS, "author_name", "published_at", "raw_payload")]
    full = items.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking if f.name not in items.columns])
    rows = full.drop("content_hash", "reason").join(taken, order).withColumn("language", F.coalesce(or_null(F.col("source_language")), "detected"))
    place = F.to_json(F.struct(order) if run is None else F.struct(F.lit(run).alias("run"), order))
    made: dict[str, Column] = {
        "id": F.sha2(F.concat_ws("|", F.col("source_id"), F.coalesce("external_content_id", F.lit("")), place), 256),
        "content_type": S.content_type(F.col("source_content_type")),
        "content_text": F.col("raw_text"),
        "normalized_text": or_null(F.col("normalized_text")),
        "summary_raw": F.lit(None),
        "fetched_at": run_at,
        "raw_payload": F.when(F.col("raw_payload") != "{}", F.col("raw_payload")),
        "status": F.lit("deduplicated"),
        "topic_cluster_id": F.lit(None),
        "created_at": run_at,
    }
    return rows.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in CONTENT_ITEMS.fields])


def run_results(
    outcomes: DataFrame, errors: DataFrame | None = None, by: str = "source_id", checked: DataFrame | None = None
) -> DataFrame:
    """Counters per source (column ``by``).

    ``errors`` adds one error for each source whose fetch failed, ``checked`` a row of zeros for a source
    without items.
    """

    def counter(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome)

    tallies = outcomes.select(by, "outcome", F.lit(1).alias("fetched"))
    if errors is not None:
        tallies = tallies.unionByName(errors.select(by, F.lit("error").alias("outcome"), F.lit(0).alias("fetched")))
    if checked is not None:
        tallies = tallies.unionByName(checked.select(by, F.lit("none").alias("outcome"), F.lit(0).alias("fetched")))
    return tallies.groupBy(by).agg(
        F.sum("fetched").alias("fetched"),
        counter("saved").alias("saved"),
        counter("duplicate").alias("duplicates"),
        counter("skipped").alias("skipped"),
        counter("error").alias("errors"),
    ).withColumn("success", F.col("errors") == 0)


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of a run, one row; skipped items are not part of them."""
    return results.agg(
        F.count("*").alias("sources"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("fetched", "saved", "duplicates", "errors")],
        F.count_if(~F.col("success")).alias("failed_sources"),
    )


def failed_sources(results: DataFrame) -> DataFrame:
    """The sources a run failed on, as rows: their number may grow with the registry."""
    return results.where(~F.col("success"))
