"""Every operator as a query over the given tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signal_lake.functions import html as H, registry_fields as R, scalars as S, text as X
from signal_lake.operators import language as L, stored_changes as C, tables as T
from signal_lake.operators.dedup import mark_duplicates
from signal_lake.operators.skew import first_n
from signal_lake.plans import ingest as I, registry as G, run as P
from signal_lake.plans.views import load
from signal_lake.session import shared_dir, stage
from signal_lake.sources import channel, feed_dumps, feeds, hf, hn, manual, router, transcript, web
from signal_lake.streaming import ingest_stream as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OUTCOME = ["arrival", "source_id", "external_content_id", "content_hash", "inserted", "is_duplicate", "outcome", "reason"]
SEED_TIME = "2024-01-01T00:00:00Z"
RUN_TIME = "2024-02-01T00:00:00Z"


def query(fn: Query) -> Query:
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = pinned
    return fn


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _epoch(name: str) -> Column:
    return F.unix_seconds(name).alias(name)


def _seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.transform_registry(load(spark, sf_dir, "registry_raw"))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.new_sources(_seed(spark, sf_dir), _at(SEED_TIME))


def _flat(seeds: DataFrame) -> DataFrame:
    return G.flatten(seeds).drop("row_no")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "raw_items")


# --- text and scalars -------------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    """Cleaned text of every item."""
    return _raw(spark, sf_dir).select("arrival", X.clean_text(F.col("raw_text")).alias("normalized_text"))


@query
def boilerplate(spark, sf_dir):
    """Lines of every item and how many of them are boilerplate."""
    lines = X.split_lines(F.coalesce("raw_text", F.lit("")))
    return _raw(spark, sf_dir).select(
        "arrival",
        F.size(lines).cast("bigint").alias("n_lines"),
        F.size(F.filter(lines, X.is_boilerplate)).cast("bigint").alias("n_boilerplate"),
        F.sha2(X.drop_boilerplate(F.coalesce("raw_text", F.lit(""))), 256).alias("kept_sha"),
    )


@query
def html_text(spark, sf_dir):
    """Text of every page, all markup stripped."""
    return load(spark, sf_dir, "pages_marked").select("page_id", H.strip_html(F.col("html")).alias("page_text"))


@query
def ad_filter(spark, sf_dir):
    items = _raw(spark, sf_dir)
    advert = (F.col("fetch_method") == "telegram_api") & S.is_advert(F.col("raw_text"))
    return items.select("arrival", advert.alias("is_ad"))


@query
def min_length(spark, sf_dir):
    cleaned = I.with_clean_text(_raw(spark, sf_dir))
    return cleaned.select(
        "arrival", F.length("normalized_text").cast("bigint").alias("n_chars"),
        S.is_short(F.col("normalized_text")).alias("is_short"),
    )


@query
def parse_dates(spark, sf_dir):
    records = load(spark, sf_dir, "landed_manual")
    return records.select("rec", "published_at", F.unix_seconds(S.parse_datetime(F.col("published_at"))).alias("epoch"))


@query
def content_hash(spark, sf_dir):
    cleaned = I.with_clean_text(_raw(spark, sf_dir))
    prints = S.content_hash(F.col("source_id"), F.col("url"), F.col("title"), F.col("normalized_text"))
    return cleaned.select("arrival", prints.alias("content_hash"))


@query
def content_types(spark, sf_dir):
    """Number of items by the type their connector's records map to."""
    kinds = load(spark, sf_dir, "events").select(
        F.concat(F.lit("hf_"), "event_type").alias("source_content_type")
    ).unionByName(_raw(spark, sf_dir).select("source_content_type"))
    typed = kinds.withColumn("content_type", S.content_type(F.col("source_content_type")))
    return typed.groupBy("source_content_type", "content_type").agg(F.count("*").alias("n_items"))


@query
def video_ids(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    code = F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 11)
    url = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), code))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("https://youtu.be/"), code, F.lit("?t=3")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("https://youtu.be/"), F.substring(code, 1, 9)))
        .otherwise(F.concat(F.lit("https://ex.org/"), code))
    )
    return events.select("event_id", X.video_id(url).alias("video_id"))


@query
def language_detect(spark, sf_dir):
    """Detected language of each text, by a model trained on the even documents; the odd ones are held out."""
    docs = load(spark, sf_dir, "documents")
    held_out = F.col("doc_id") % 2 == 1
    profile = L.train_profile(docs.where(~held_out), "text", "lang")
    found = L.detect(docs.select("doc_id", "text"), "doc_id", "text", profile)
    return docs.select("doc_id", "lang", held_out.alias("held_out")).join(found, "doc_id", "left")


@query
def language_fill(spark, sf_dir):
    """Language of every item: the source's, else the detected one."""
    items = _raw(spark, sf_dir)
    cleaned = stage(I.with_clean_text(items), "cleaned")
    return I.fill_language(cleaned, "arrival", I.language_profile(cleaned)).select("arrival", "source_language", "language")


@query
def normalized_items(spark, sf_dir):
    """Everything normalisation derives of an item."""
    day = F.lpad((F.col("arrival") % 28 + 1).cast("string"), 2, "0")
    dated = _raw(spark, sf_dir).withColumn("published_at", S.parse_datetime(F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00+03"))))
    return I.normalized_items(dated).select(
        "arrival", "source_id", "external_content_id", "content_type", "normalized_text", "content_hash", "language", "status", _epoch("published_at")
    )


# --- dedup and ingestion ----------------------------------------------------------------------


@query
def dedup_batch(spark, sf_dir):
    """Duplicate marks when nothing is screened out first."""
    items = I.normalized_items(_raw(spark, sf_dir), detect=False).select("arrival", "source_id", "external_content_id", "content_hash")
    return mark_duplicates(stage(items, "fingerprints")).select("arrival", "inserted", "is_duplicate", "outcome")


@query
def ingest_batch(spark, sf_dir):
    """Outcome of every item of one batch into an empty store."""
    return I.ingest(_raw(spark, sf_dir)).select(*OUTCOME)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The first 60 % of the items by arrival, and the rest."""
    items = _raw(spark, sf_dir)
    cut = load(spark, sf_dir, "documents").count() * 6 // 10
    return items.where(F.col("arrival") < cut), items.where(F.col("arrival") >= cut)


@query
def ingest_incremental(spark, sf_dir):
    """Outcome of the later items when the earlier ones are stored."""
    first, rest = _halves(spark, sf_dir)
    stored = stage(I.ingest(first).where("inserted"), "stored")
    return I.ingest(rest, stored).select(*OUTCOME)


@query
def content_items(spark, sf_dir):
    """The stored rows one batch yields."""
    items = stage(I.prepared(_raw(spark, sf_dir)), "prepared")
    rows = I.content_rows(items, I.ingest(items), _at(RUN_TIME))
    return rows.select(
        "source_id", "external_content_id", "content_type", "source_content_type", "title",
        F.sha2("content_text", 256).alias("content_sha"), F.sha2("normalized_text", 256).alias("normalized_sha"),
        "url", "content_hash", "language", "status", "is_duplicate", _epoch("fetched_at"),
    )


@query
def ingest_stream(spark, sf_dir):
    """Outcomes through Structured Streaming: the later 60 % of the documents land first, the earlier ones come late."""
    docs = load(spark, sf_dir, "documents")
    cut = docs.count() * 4 // 10
    root = _streamed(spark, sf_dir, [F.col("doc_id") >= cut, F.col("doc_id") < cut])
    return ST.all_outcomes(spark, root).select(*OUTCOME)


@query
def ingest_stream_exact(spark, sf_dir):
    """The same in three parts, the last ones first, when late rows take their place: the result of one batch."""
    docs = load(spark, sf_dir, "documents")
    low, high = docs.count() // 3, docs.count() * 2 // 3
    root = _streamed(spark, sf_dir, [F.col("doc_id") >= high, F.col("doc_id") < low, (F.col("doc_id") >= low) & (F.col("doc_id") < high)], exact=True)
    return ST.current_outcomes(spark, root).select(*OUTCOME)


def _streamed(spark: SparkSession, sf_dir: str, parts: list[Column], exact: bool = False) -> str:
    """Folder of a stream into which parts of the documents landed one after the other, each followed by a drain."""
    import uuid

    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")

    def to_items(rows: DataFrame) -> DataFrame:
        from signal_lake.plans.views import view_sql

        return spark.sql(view_sql("raw_items").replace("FROM documents", "FROM {documents}"), documents=rows)

    for part in parts:
        docs.where(part).write.mode("append").parquet(f"{root}/landing")
        ST.land_fingerprints(spark, f"{root}/landing", docs.schema, root, to_items)
        ST.dedup_landed(spark, root, exact)
    return root


@query
def run_results(spark, sf_dir):
    """Counters per source."""
    return I.run_results(I.ingest(_raw(spark, sf_dir)))


@query
def run_summary(spark, sf_dir):
    """Totals of a run whose sources also include ones that cannot be fetched."""
    return I.run_summary(_results_with_errors(spark, sf_dir))


@query
def failed_sources(spark, sf_dir):
    return I.failed_sources(_results_with_errors(spark, sf_dir)).select("source_id", "errors")


def _results_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = router.source_errors(_sources(spark, sf_dir)).select(F.col("canonical_key").alias("source_id"))
    return I.run_results(I.ingest(_raw(spark, sf_dir)), errors)


def _registry_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items of registry sources: document n belongs to the source of list row n modulo the number of rows."""
    listed = load(spark, sf_dir, "registry_raw")
    rows = listed.count()
    keys = listed.select(
        "row_no", T.source_id(R.canonical_key(F.trim("source_name"))).alias("named_id")
    )
    docs = _raw(spark, sf_dir).drop("fetch_method", "source_language").withColumn("row_no", F.col("arrival") % rows)
    owned = docs.join(keys, "row_no").withColumn("source_id", F.col("named_id")).drop("named_id", "row_no")
    return owned.withColumnRenamed("arrival", "pos")


def _numbered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seed(spark, sf_dir).withColumn("id", T.source_id(F.col("canonical_key")))


@query
def items_enriched(spark, sf_dir):
    """All items with the columns that flow from their source; NULL for those whose list row names none."""
    sources = _numbered_sources(spark, sf_dir)
    items = _registry_items(spark, sf_dir)
    joined = I.with_source(
        items, sources, "pos", canonical_name="canonical_name", source_language="language", fetch_method="fetch_method",
        handle="handle", how="left",
    )
    return joined.select("pos", "source_id", "canonical_name", "source_language", "fetch_method", "handle")


@query
def ingest_wave1(spark, sf_dir):
    """A run over the active sources of wave 1, in the order of the run."""
    sources = _numbered_sources(spark, sf_dir)
    placed = P.placed_sources(P.select_sources(sources, wave=1))
    items = P.ordered_items(_registry_items(spark, sf_dir), placed)
    return P.with_key(I.ingest(items), placed).select(
        "canonical_key", "pos", "content_hash", "inserted", "is_duplicate", "outcome", "reason",
    )


def _landed_in(spark: SparkSession, sf_dir: str, part: Column, sources: DataFrame) -> dict[str, DataFrame]:
    """Some documents as landed records of ``sources``, those of ``_several_sources``: source n has every document n modulo a sixth of the sources."""
    listed = load(spark, sf_dir, "registry_raw")
    sixth = listed.count() // 6
    keys = listed.where(F.col("row_no").between(1, sixth)).select("row_no", R.canonical_key(F.trim("source_name")).alias("canonical_key"))
    owners = keys.join(sources, "canonical_key").select("row_no", F.col("id").alias("source_id"), F.col("fetch_method").alias("method"))
    docs = _raw(spark, sf_dir).where(part).drop("source_id").withColumns({"row_no": F.col("arrival") % sixth + 1, "pos": F.col("arrival")})
    docs = stage(docs.join(stage(owners, "owners"), "row_no"), "landed")
    nothing = F.lit(None).cast("string")
    return {
        "manual_import": docs.where("method = 'manual_import'").select("source_id", "pos", F.col("external_content_id").alias("id"), "title", F.col("raw_text").alias("text"), "url"),
        "telegram_api": docs.where("method = 'telegram_api'").select(
            "source_id", "pos", F.col("pos").alias("msg_id"), F.col("raw_text").alias("text"), nothing.alias("channel"), nothing.cast("timestamp").alias("date"),
            nothing.cast("int").alias("views"), nothing.cast("int").alias("replies"), F.lit(False).alias("has_media"), nothing.cast("bigint").alias("grouped_id"),
        ),
        "rss": docs.where("method = 'rss'").select(
            "source_id", "pos", "title", F.col("url").alias("link"), F.col("raw_text").alias("summary"), nothing.alias("content"), F.col("external_content_id").alias("entry_id"),
            nothing.alias("published"), nothing.alias("author"), F.array(nothing).alias("tags"),
        ),
    }


def _several_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list's sources, each of one of three methods, with the settings these need."""
    method = F.element_at(F.array(F.lit("manual_import"), F.lit("telegram_api"), F.lit("rss")), (F.col("row_no") % 3 + 1).cast("int"))
    seed = _seed(spark, sf_dir).withColumn("fetch_method", method)
    return T.new_sources(seed.withColumn("fetch_config", F.lit('{"file_path": "/in/x.json", "channel": "@c", "feed_url": "https://ex.org/feed"}')), _at(SEED_TIME))


@query
def run_twice(spark, sf_dir):
    """What is stored after two runs over three connectors, with the counters of the item's source in both.

    The first run lands the first 70 % of the documents, the second the last 60 %: what landed before is met again.
    """
    import uuid

    root = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
    n = load(spark, sf_dir, "documents").count()
    P.write_sources(_several_sources(spark, sf_dir), root, 1)
    counters = []
    for run, part in enumerate((F.col("arrival") < n * 7 // 10, F.col("arrival") >= n * 4 // 10), 1):
        at = _at(SEED_TIME if run == 1 else RUN_TIME)
        sources = P.read_sources(spark, root, run)
        results = P.run_ingestion(spark, root, sources, _landed_in(spark, sf_dir, part, sources), at, version=run + 1, detect=False, run=run)
        named = results.join(sources.select("canonical_key", F.col("id").alias("source_id")), "canonical_key")
        counters.append(named.select("source_id", *[F.col(c).alias(f"{c}_{run}") for c in ("fetched", "saved", "duplicates", "skipped")]))
    items = P.read_items(spark, root).select("source_id", "external_content_id", "title", "content_hash", "language", "is_duplicate", _epoch("fetched_at"))
    return items.join(counters[0], "source_id").join(counters[1], "source_id")


# --- registry ---------------------------------------------------------------------------------


@query
def registry_keys(spark, sf_dir):
    return load(spark, sf_dir, "registry_raw").select(
        "row_no", R.canonical_key(F.trim("source_name")).alias("canonical_key")
    )


@query
def registry_handles(spark, sf_dir):
    pair = R.url_and_handle(F.col("url_or_handle"), F.col("primary_platform"))
    return load(spark, sf_dir, "registry_raw").select("row_no", pair["url"].alias("url"), pair["handle"].alias("handle"))


@query
def registry_methods(spark, sf_dir):
    method = R.fetch_method(F.col("primary_platform"), F.col("url_or_handle"))
    return load(spark, sf_dir, "registry_raw").select(
        "row_no", method.alias("fetch_method"), R.wave(method).alias("wave"), R.language(F.col("region")).alias("language"),
        R.monitoring_frequency(F.col("monitoring_frequency")).alias("monitoring_frequency"),
    )


@query
def registry_dedup(spark, sf_dir):
    """The row kept of each key."""
    return _seed(spark, sf_dir).select("canonical_key", "row_no", "source_name")


@query
def registry_transform(spark, sf_dir):
    """All columns of the transformed registry, lists shown as text."""
    return _flat(_seed(spark, sf_dir))


@query
def registry_flat(spark, sf_dir):
    """The CSV form, read back from the JSON form."""
    import uuid

    path = f"{shared_dir(spark)}/seed-{uuid.uuid4().hex}"
    G.write_seed(_seed(spark, sf_dir), f"{path}/json", f"{path}/csv")
    return G.flatten(G.read_seed(spark, f"{path}/json"))


@query
def dry_run(spark, sf_dir):
    """Counters of a dry run over all sources when nothing landed but feeds that don't parse."""
    import uuid

    listed = load(spark, sf_dir, "registry_raw")
    rows = listed.count()
    keys = listed.select("row_no", R.canonical_key(F.trim("source_name")).alias("canonical_key"))
    _, failed = feeds.feed_entries(_feeds(spark, sf_dir), ["doc_id"])
    failures = failed.select((F.col("doc_id") % rows).alias("row_no"), "message").join(keys, "row_no")
    root = f"{shared_dir(spark)}/dry-{uuid.uuid4().hex}"
    results = P.run_ingestion(spark, root, _sources(spark, sf_dir), {}, _at(RUN_TIME), version=1, dry_run=True, failures=failures)
    return results.select("canonical_key", "fetched", "saved", "errors", "success")


@query
def registry_load(spark, sf_dir):
    """A load of the list over a stored registry: the table after it, and the rows that stay in quarantine."""
    third = load(spark, sf_dir, "customer").count() // 3
    rows = load(spark, sf_dir, "registry_raw")
    first = G.transform_registry(rows.where(F.col("row_no") <= third))
    stored = T.new_sources(T.split_quarantine(first)[0], _at(SEED_TIME)).withColumn("tier", F.lit(1).cast("smallint"))
    merged, bad = G.load_registry(rows, stored, _at(RUN_TIME))
    loaded = merged.select("canonical_key", "tier", _epoch("created_at"), _epoch("updated_at"), F.lit("").alias("violations"))
    missing = F.lit(None).cast("bigint")
    return loaded.unionByName(bad.select(
        "canonical_key", "tier", missing.alias("created_at"), missing.alias("updated_at"), F.array_join("violations", ";").alias("violations")
    ))


@query
def registry_configs(spark, sf_dir):
    """Settings and platforms of sources that carry them as JSON text, decoded."""
    config = F.concat(F.lit('{"limit": '), F.col("row_no").cast("string"), F.lit(', "languages": ["ru", "'), F.col("canonical_key"), F.lit('"]}'))
    rows = _seed(spark, sf_dir).withColumns({"fetch_config": config, "platforms": F.to_json("platforms")})
    decoded = G.decode_config(rows)
    return decoded.select(
        "canonical_key", F.col("fetch_config.limit").cast("bigint").alias("item_limit"), F.array_join("fetch_config.languages", ",").alias("languages"),
        F.array_join("platforms", ";").alias("platforms"),
    )


@query
def csv_import(spark, sf_dir):
    """Documents written as two CSV imports of different header order, read back by name."""
    import uuid

    path = f"{shared_dir(spark)}/import-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("raw_text"), F.col("source").alias("author"))
    even = F.col("id").cast("bigint") % 2 == 0
    for name, part in (("a", docs.where(even)), ("b", docs.where(~even).select("author", "raw_text", "id"))):
        part.write.csv(f"{path}/{name}", header=True, escape='"', quoteAll=True)
    records = manual.read_csv(spark, [f"{path}/a", f"{path}/b"])
    return manual.manual_items(records, []).select("external_content_id", "author_name", F.sha2("raw_text", 256).alias("text_sha"))


def _json_lists(documents: int) -> int:
    """So many lists that none holds more than about 50,000 documents, since one task writes a whole file."""
    return max(4, -(-documents // 50_000))


@query
def json_import(spark, sf_dir):
    """Documents written as JSON lists, a file for each 50,000 of them and at least four, which hold other entries too; read back by the settings of their sources."""
    import uuid

    path = f"{shared_dir(spark)}/lists-{uuid.uuid4().hex}"
    lists = _json_lists(load(spark, sf_dir, "documents").count())
    docs = load(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(lists)).alias("g"), F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("raw_text"), F.col("source").alias("author"))).alias("json"))
    entry = F.concat(F.lit(', "no } record", ['), F.col("json"), F.lit("], "), F.col("json")).alias("value")
    ends = spark.range(lists).selectExpr("id AS g", "inline(array(struct(-1L AS doc_id, '[0' AS value), struct(9223372036854775807L AS doc_id, ']' AS value)))")
    rows = docs.select("g", "doc_id", entry).unionByName(ends)
    rows.repartition("g").sortWithinPartitions("g", "doc_id").select("g", "value").write.partitionBy("g").text(path)
    files = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
    names = [(f"list {k}", json.dumps({"file_path": file, "file_format": "json"})) for k, file in enumerate(sorted(files))]
    listed = spark.createDataFrame(names, "canonical_key string, fetch_config string")
    sources = listed.select("canonical_key", T.source_id(F.col("canonical_key")).alias("id"), F.lit("manual_import").alias("fetch_method"), "fetch_config")
    records, _ = manual.read_source_imports(spark, sources)
    return manual.manual_items(records, []).select("external_content_id", "author_name", F.sha2("raw_text", 256).alias("text_sha"))


@query
def registry_list(spark, sf_dir):
    """The list written as CSV, read by the names of its header and transformed."""
    import uuid

    path = f"{shared_dir(spark)}/list-{uuid.uuid4().hex}"
    listed = load(spark, sf_dir, "registry_raw")
    noted = listed.withColumn("why_relevant", F.concat(F.lit('note "'), F.col("row_no").cast("string"), F.lit('",\nsecond line')))
    noted.orderBy("row_no").drop("row_no").write.csv(path, header=True, escape='"', quoteAll=True)
    seeds = G.transform_registry(G.read_registry_csv(spark, path))
    return seeds.select("canonical_key", "source_name", "fetch_method", "tier", "notes")


@query
def distinct_stream(spark, sf_dir):
    """Fingerprints that a stream lets through when it drops repeats within the watermark."""
    import uuid

    root = f"{shared_dir(spark)}/distinct-{uuid.uuid4().hex}"
    prints = I.fingerprints(_raw(spark, sf_dir)).where(F.col("content_hash").isNotNull())
    prints.select("content_hash", F.timestamp_seconds("arrival").alias("at")).write.parquet(f"{root}/landing")
    landed = spark.readStream.schema("content_hash string, at timestamp").parquet(f"{root}/landing")
    kept = ST.distinct_within(landed, "at", "3650 days")
    writer = kept.writeStream.format("parquet").option("path", f"{root}/kept").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("content_hash string").parquet(f"{root}/kept")


@query
def routed_items(spark, sf_dir):
    """Records of several methods, both listings and a connector of its own among them, as one table of items."""
    docs = load(spark, sf_dir, "documents")
    listing = docs.where("doc_id % 4 < 2").selectExpr(
        "doc_id", "CASE WHEN doc_id % 4 = 0 THEN 'daily_papers' ELSE 'trending_models' END AS feed",
        """CASE WHEN doc_id % 4 = 0 THEN to_json(named_struct('paper', named_struct('id', concat('p', doc_id), 'title', source, 'summary', text)))
           ELSE to_json(named_struct('id', concat('m', doc_id), 'author', source, 'tags', array(lang))) END AS json""",
    )
    manual_records = docs.where("doc_id % 4 = 2").selectExpr("doc_id", "CAST(doc_id AS STRING) AS id", "text", "source AS author")
    own = docs.where("doc_id % 4 = 3").selectExpr("doc_id", "concat('o', doc_id) AS id", "text", "lang AS author")
    router.register_connector("own_api", manual.manual_items)
    items = router.route({"huggingface_api": listing, "manual_import": manual_records, "own_api": own}, ["doc_id"])
    return items.select("doc_id", "fetch_method", "external_content_id", "source_content_type", "author_name", F.sha2("raw_text", 256).alias("text_sha"))


@query
def registry_violations(spark, sf_dir):
    """Constraints each source row breaks."""
    rows = _seed(spark, sf_dir)
    return rows.select("canonical_key", F.array_join(T.violations(rows), ";").alias("violations"))


@query
def registry_profile(spark, sf_dir):
    return G.profile(_seed(spark, sf_dir))


@query
def active_sources(spark, sf_dir):
    """Active sources of one method and wave with their place in the run's order per tier."""
    chosen = G.active_sources(_mixed_sources(spark, sf_dir), method="rss", wave=1)
    return chosen.orderBy(*G.processing_order()).select("tier", "wave", "source_name", "canonical_key", "fetch_method")


@query
def source_by_key(spark, sf_dir):
    """Lookups by key: which keys name a source that can run."""
    wanted = _seed(spark, sf_dir).select("canonical_key")
    known = _mixed_sources(spark, sf_dir).select("canonical_key", "is_active")
    missing = load(spark, sf_dir, "registry_raw").select(
        F.concat(F.lit("gone-"), F.col("row_no").cast("string")).alias("canonical_key")
    )
    return G.keys_with_problem(known, wanted.unionByName(missing))


def _mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of which every seventh list row is switched off."""
    return _seed(spark, sf_dir).withColumn("is_active", F.col("row_no") % 7 != 0)


@query
def unroutable_sources(spark, sf_dir):
    """Sources of methods without a connector, when every ninth list row names an unknown one."""
    rows = _seed(spark, sf_dir).withColumn(
        "fetch_method", F.when(F.col("row_no") % 9 == 0, F.concat(F.lit("m_"), "fetch_method")).otherwise(F.col("fetch_method"))
    )
    return rows.where(router.unroutable(F.col("fetch_method"))).select("canonical_key", "fetch_method")


@query
def source_errors(spark, sf_dir):
    """Sources that cannot be fetched, and why."""
    return router.source_errors(_sources(spark, sf_dir))


@query
def upsert_sources(spark, sf_dir):
    """Stored: list rows up to two thirds, older, some switched off; seed: rows from one third on."""
    seed = _seed(spark, sf_dir)
    third = load(spark, sf_dir, "customer").count() // 3
    stored = T.new_sources(seed.where(F.col("row_no") <= 2 * third), _at(SEED_TIME))
    stored = stored.withColumn("is_active", F.lit(False)).withColumn("error_count", F.lit(3)).withColumn("tier", F.lit(1).cast("smallint"))
    merged = T.upsert_sources(stored, seed.where(F.col("row_no") > third), _at(RUN_TIME))
    return merged.select(
        "id", "canonical_key", "source_name", "tier", "is_active", "error_count", _epoch("created_at"), _epoch("updated_at")
    )


@query
def source_state(spark, sf_dir):
    """State after a run: failed sources get an error, the others are touched."""
    sources = _sources(spark, sf_dir)
    errors = router.source_errors(sources)
    noted = errors.where("recorded").select("canonical_key", "message", F.lit(0).alias("seq"))
    checked = sources.join(errors.select("canonical_key"), "canonical_key", "left_anti").select("canonical_key")
    after = T.record_state(sources, noted, checked, _at(RUN_TIME))
    return after.select(
        "canonical_key", "error_count", "last_error_msg", _epoch("last_error_at"), _epoch("last_checked_at"), _epoch("updated_at")
    )


@query
def status_update(spark, sf_dir):
    """Statuses after two rounds of changes, the later one counting."""
    items = _raw(spark, sf_dir).select(F.col("arrival").alias("id"), F.lit("deduplicated").alias("status"))
    changes = load(spark, sf_dir, "events").select(
        (F.col("event_id") % load(spark, sf_dir, "documents").count()).alias("id"),
        F.when(F.col("event_id") % 3 == 0, "candidate").otherwise("selected").alias("status"),
        F.col("event_id").alias("seq"),
    )
    return T.update_status(items, changes)


@query
def cascade_delete(spark, sf_dir):
    """Items left when every source with an even number in its name is removed."""
    items = _raw(spark, sf_dir).select("arrival", "source_id")
    removed = items.where(F.substring("source_id", 4, 9).cast("int") % 2 == 0).select("source_id")
    return T.cascade_delete(items, removed, "arrival")


@query
def stored_changes(spark, sf_dir):
    """A stored table, partitioned by source, after statuses were set and sources removed, partition by partition."""
    import uuid

    path = f"{shared_dir(spark)}/items-{uuid.uuid4().hex}"
    items = _raw(spark, sf_dir).select(F.col("arrival").alias("id"), "source_id", F.lit("deduplicated").alias("status"))
    items.withColumn("bucket", C.source_bucket(8)).write.partitionBy("bucket").parquet(path)

    def stored() -> DataFrame:
        return spark.read.schema("id bigint, source_id string, status string, bucket int").parquet(path)

    changes = load(spark, sf_dir, "events").where("event_id % 5 = 0").select(
        (F.col("event_id") % load(spark, sf_dir, "documents").count()).alias("id"),
        F.when(F.col("event_id") % 3 == 0, "candidate").otherwise("selected").alias("status"), F.col("event_id").alias("seq"),
    )
    C.set_statuses(stored(), path, ["bucket"], changes)
    removed = items.where(F.substring("source_id", 4, 9).cast("int") % 7 == 2).select("source_id")
    C.delete_sources(stored(), path, ["bucket"], removed, "id")
    return stored().select("id", "source_id", "status")


# --- connectors -------------------------------------------------------------------------------


def _shown(items: DataFrame, *names: str) -> DataFrame:
    return items.select(*[_epoch(n) if n == "published_at" else n for n in names])


@query
def manual_items(spark, sf_dir):
    items = manual.manual_items(load(spark, sf_dir, "landed_manual"), ["rec"])
    return _shown(items, "rec", "external_content_id", "source_content_type", "raw_text", "published_at", "engagement_like_count")


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed feed per document, of eleven kinds in turn.

    RSS, Atom, RSS 1.0, Atom with markup, an address as id, broken, empty, no feed, Atom with prefixes, Atom that mentions
    RSS elements in its text, and RSS that breaks off in its second item.
    """

    def xml(column: str) -> str:
        return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    rss = f"""concat('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title>',
      '<item><title>T ', doc_id, '</title><link>https://ex.org/', doc_id, '</link><description>', {xml('text')}, '</description>',
      '<guid>g', doc_id, '</guid><pubDate>Fri, 05 Jan 2024 10:00:00 +0300</pubDate><dc:creator>', source, '</dc:creator><category>a</category><category>b</category></item>',
      '<item><title>U</title><link>https://ex.org/u', doc_id, '</link><content:encoded>', {xml('text')}, '</content:encoded></item></channel></rss>')"""
    atom = f"""concat('<feed xmlns="http://www.w3.org/2005/Atom"><title>c</title><entry><title>A ', doc_id, '</title>',
      '<link rel="alternate" href="https://ex.org/a', doc_id, '"/><summary>', {xml('text')}, '</summary><id>a', doc_id, '</id>',
      '<updated>2024-01-05T10:00:00Z</updated><author><name>', source, '</name></author></entry></feed>')"""
    rdf = f"""concat('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title></channel>',
      '<item rdf:about="r', doc_id, '"><title>R&nbsp;', doc_id, '</title><link>https://ex.org/r', doc_id, '</link><description>', {xml('text')}, '</description><dc:date>2024-01-05</dc:date></item></rdf:RDF>')"""
    xhtml = f"""concat('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml">X ', doc_id, '</div></title>',
      '<link href="https://ex.org/x', doc_id, '"/><content type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml">', {xml('text')}, '</div></content><id>x', doc_id, '</id></entry></feed>')"""
    permalink = f"""concat('<rss><channel><item><title>P ', doc_id, '</title><guid isPermaLink="true">https://ex.org/p', doc_id, '</guid><description>', {xml('text')}, '</description></item></channel></rss>')"""
    broken = f"""concat('<rss><channel><item><title>B ', doc_id, '</item>', {xml('text')}, '</channel></rss>')"""
    prefixed = f"""concat('<?xml version="1.0"?><!-- <rss> --><atom:feed xmlns:atom="http://www.w3.org/2005/Atom"><atom:title>c</atom:title><atom:entry><atom:title>N ', doc_id, '</atom:title>',
      '<atom:link href="https://ex.org/n', doc_id, '"/><atom:summary>', {xml('text')}, '</atom:summary><atom:id>n', doc_id, '</atom:id><atom:author><atom:name>', source, '</atom:name></atom:author></atom:entry></atom:feed>')"""
    mentions = f"""concat('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>M ', doc_id, '</title><link href="https://ex.org/m', doc_id, '"/>',
      '<summary><![CDATA[a <channel> of <rss version="2.0"> and <atom:item> ', doc_id, ']]></summary><id>m', doc_id, '</id></entry></feed>')"""
    cut = f"""concat('<rss version="2.0"><channel><title>c</title><item><title>C ', doc_id, '</title><guid>c', doc_id, '</guid><description>', {xml('text')}, '</description></item>',
      '<item><title>lost</title><description>', substr({xml('text')}, 1, 20))"""
    kinds = {8: prefixed, 9: mentions, 10: cut, 0: rss, 1: atom, 2: rdf, 3: xhtml, 4: permalink, 5: broken, 6: "'<rss><channel><title>none</title></channel></rss>'", 7: f"concat('<html>', {xml('text')}, '</html>')"}
    chosen = " ".join(f"WHEN {kind} THEN {text}" for kind, text in kinds.items())
    return load(spark, sf_dir, "documents").selectExpr("doc_id", f"CASE doc_id % 11 {chosen} END AS xml")


@query
def feed_items(spark, sf_dir):
    entries, _ = feeds.feed_entries(_feeds(spark, sf_dir), ["doc_id"])
    items = feeds.feed_items(entries, ["doc_id", "pos"])
    shown = items.withColumn("pos", F.col("pos").cast("bigint")).withColumn("text_sha", F.sha2(F.regexp_replace("raw_text", r"\s+", ""), 256))
    return _shown(shown, "doc_id", "pos", "external_content_id", "title", "url", "author_name", "published_at", "text_sha")


@query
def feed_errors(spark, sf_dir):
    """Feeds that are an error: those that don't parse, and pages that are no feed; an empty feed is none."""
    return feeds.feed_entries(_feeds(spark, sf_dir), ["doc_id"])[1]


def _feed_dumps(spark: SparkSession, sf_dir: str) -> str:
    """Folder of five feed files with an entry per document in turn, by doc_id modulo 5.

    RSS with entries in comments, Atom with prefixes, RSS 1.0, RSS with CDATA that mentions entries and broken off in its last one, and a page that is no feed.
    """
    import uuid

    path = f"{shared_dir(spark)}/dumps-{uuid.uuid4().hex}"
    text = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    entries = {
        0: f"concat('<!-- <item><title>no</title></item> --><item><title>T ', doc_id, '</title><guid>g', doc_id, '</guid><description>', {text}, '</description></item>')",
        1: f"concat('<atom:entry><atom:title>A ', doc_id, '</atom:title><atom:id>a', doc_id, '</atom:id><atom:summary>', {text}, '</atom:summary></atom:entry>')",
        2: f"concat('<item rdf:about=\"r', doc_id, '\"><title>R ', doc_id, '</title><description>', {text}, '</description></item>')",
        3: "concat('<item><title>C ', doc_id, '</title><guid>c', doc_id, '</guid><description><![CDATA[<item> <!-- ', replace(text, ']]>', ''), ']]></description></item>')",
        4: f"concat('<li>', {text}, '</li>')",
    }
    ends = {
        0: ("<?xml version=\"1.0\"?><rss version=\"2.0\"><channel><title>c</title>", "</channel></rss>"),
        1: ('<atom:feed xmlns:atom="http://www.w3.org/2005/Atom"><atom:title>c</atom:title>', "</atom:feed>"),
        2: ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"><channel><title>c</title></channel>', "</rdf:RDF>"),
        3: ('<rss version="2.0"><channel><title>c</title>', "<item><title>lost</title><descr"),
        4: ("<html><body><ul>", "</ul></body></html>"),
    }
    chosen = " ".join(f"WHEN {kind} THEN {entry}" for kind, entry in entries.items())
    rows = load(spark, sf_dir, "documents").selectExpr("doc_id % 5 AS g", "1 AS part", "doc_id", f"CASE doc_id % 5 {chosen} END AS value")
    around = [(kind, part, 0, value) for kind, pair in ends.items() for part, value in zip((0, 2), pair, strict=True)]
    rows = rows.unionByName(spark.createDataFrame(around, "g bigint, part int, doc_id bigint, value string"))
    rows.repartition("g").sortWithinPartitions("g", "part", "doc_id").select("g", "value").write.partitionBy("g").text(path)
    return path


@query
def feed_dump(spark, sf_dir):
    """Entries of large feed files, each read by all tasks; ``ahead`` entries stand before each in its file."""
    entries, _ = feed_dumps.dump_entries(spark, _feed_dumps(spark, sf_dir))
    items = feeds.feed_items(entries, ["file_path", "pos"]).withColumn("text_sha", F.sha2(F.regexp_replace("raw_text", r"\s+", ""), 256))
    return items.select(F.regexp_extract("file_path", "g=([0-9]+)", 1).cast("bigint").alias("g"), F.col("pos").alias("ahead"), "external_content_id", "title", "text_sha")


@query
def feed_dump_errors(spark, sf_dir):
    """What large feed files hold that is no feed or doesn't parse."""
    _, errors = feed_dumps.dump_entries(spark, _feed_dumps(spark, sf_dir))
    return errors.select(F.regexp_extract("file_path", "g=([0-9]+)", 1).cast("bigint").alias("g"), "pos", "message")


def _hn(spark: SparkSession, sf_dir: str, listed: Column | None = None, **choice) -> DataFrame:
    items = load(spark, sf_dir, "hn_items").select(
        "*", F.lit(None).cast("string").alias("text"), F.col("author").alias("by"),
        F.unix_seconds(F.col("time_ts").cast("timestamp")).alias("time"),
        F.get_json_object("props", "$.k").cast("int").alias("descendants"),
        F.lit(None).cast("array<bigint>").alias("kids"),
    )
    ranking = load(spark, sf_dir, "hn_feed")
    picked = hn.pick_items(ranking if listed is None else ranking.where(listed), items, **choice)
    shown = hn.hn_items(picked, ["id", "feed_rank"]).withColumn("feed_rank", F.col("feed_rank").cast("bigint"))
    return _shown(
        shown, "id", "feed_rank", "external_content_id", "title", "raw_text", "url", "author_name", "published_at", "engagement_comment_count"
    )


@query
def hn_items(spark, sf_dir):
    """The first thirty places of the ranked feed."""
    return _hn(spark, sf_dir)


@query
def hn_show(spark, sf_dir):
    """Show posts with a score among the first two thousand places."""
    return _hn(spark, sf_dir, limit=2000, feed="showhn", min_score=5)


@query
def hf_papers(spark, sf_dir):
    """Papers landed as listing JSON, one per document."""
    landed = load(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        """to_json(named_struct('paper', named_struct('id', concat('p', doc_id), 'title', concat('Paper ', doc_id), 'summary', text,
           'publishedAt', CASE doc_id % 4 WHEN 0 THEN '2024-01-05T10:00:00.000Z' WHEN 1 THEN '2024-01-05T10:00:00+03:00' WHEN 2 THEN 'soon' END,
           'authors', CASE WHEN doc_id % 3 > 0 THEN array(named_struct('name', source), named_struct('name', 'second')) END),
           'numComments', CAST(doc_id % 50 AS INT), 'upvotes', CAST(doc_id % 7 AS INT))) AS json""",
    )
    return _shown(
        hf.paper_items(landed, ["doc_id"]),
        "doc_id", "external_content_id", "title", "raw_text", "url", "author_name", "published_at", "engagement_comment_count",
    )


@query
def hf_models(spark, sf_dir):
    """Models landed as listing JSON, one per event."""
    landed = load(spark, sf_dir, "events").selectExpr(
        "event_id",
        """to_json(named_struct('id', concat('org/m', event_id), 'author', event_type, 'createdAt', '2024-01-05T10:00:00.000Z',
           'tags', transform(sequence(1, CAST(event_id % 13 AS INT) + 1), i -> concat('t', i)), 'likes', CAST(event_id % 9 AS INT))) AS json""",
    )
    items = hf.model_items(landed, ["event_id"])
    n_tags = F.size(F.from_json(F.get_json_object("raw_payload", "$.tags"), "array<string>")).cast("bigint")
    return _shown(
        items.withColumn("payload_tags", n_tags),
        "event_id", "external_content_id", "title", "raw_text", "url", "author_name", "published_at", "payload_tags",
    )


@query
def channel_messages(spark, sf_dir):
    """The newest three messages of each channel above number 1, empty ones dropped after the cut."""
    messages = load(spark, sf_dir, "messages").select(
        "*", F.concat(F.lit("@c"), F.col("channel_id").cast("string")).alias("channel"),
        F.lit(None).cast("timestamp").alias("date"), F.lit(None).cast("int").alias("views"),
        F.lit(None).cast("int").alias("replies"), F.lit(False).alias("has_media"), F.lit(None).cast("bigint").alias("grouped_id"),
    )
    picked = channel.pick_messages(messages, ["channel_id"], limit=3, min_id=1, bound=3)
    return _shown(
        channel.message_items(picked, ["channel_id", "msg_id"]),
        "channel_id", "msg_id", "external_content_id", "source_content_type", "raw_text", "url",
    )


@query
def channel_cursor(spark, sf_dir):
    """Where the next run of each channel starts."""
    return channel.cursor(load(spark, sf_dir, "messages"), ["channel_id"])


@query
def transcripts(spark, sf_dir):
    """Conversations as segments of a transcript."""
    segments = load(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"), F.col("turn").alias("pos"), "text"
    )
    videos = transcript.assemble(segments, ["video_id"]).select(
        "*", F.lit("Channel").alias("canonical_name"), F.lit("en").alias("lang"), F.lit(False).alias("is_generated")
    )
    items = transcript.transcript_items(videos, ["video_id", "segment_count"])
    return _shown(items, "video_id", "segment_count", "raw_text", "url", "author_name")


@query
def transcript_pick(spark, sf_dir):
    """The transcript chosen of each video; the candidates are the events of a user."""
    candidates = load(spark, sf_dir, "events").selectExpr(
        "user_id AS video_id",
        """CASE WHEN user_id % 4 = 0 THEN CASE event_id % 2 WHEN 0 THEN 'de' ELSE 'fr' END
           ELSE CASE event_id % 5 WHEN 0 THEN 'ru' WHEN 1 THEN 'en' WHEN 2 THEN 'de' ELSE 'fr' END END AS lang""",
        "event_type <> 'view' OR user_id % 3 = 0 AS is_generated",
    )
    return transcript.pick_transcript(candidates, ["video_id"])


@query
def web_items(spark, sf_dir):
    items = web.web_items(load(spark, sf_dir, "pages_aug"), ["page_id"])
    return _shown(items, "page_id", "external_content_id", "title", "raw_text", "url")


@query
def page_changes(spark, sf_dir):
    """State of each snapshot against the one before; each snapshot is a block of its own, so all is carried."""
    changes = web.page_changes(load(spark, sf_dir, "page_snapshots"), F.floor(F.col("snap") / 2))
    return changes.select("url", "snap", "state")


@query
def page_change_items(spark, sf_dir):
    """An item of every page that has changed, with the lines that came and went."""
    items = web.changed_items(load(spark, sf_dir, "page_snapshots"), F.floor(F.col("snap") / 2))
    return items.select("external_content_id", "url", "snap", "raw_text", F.array_join("removed", "|").alias("removed"))


@query
def hn_ask(spark, sf_dir):
    """Ask posts of the list that the feed's short name stands for, when every other place is one of that list."""
    which = F.when(F.col("feed_rank") % 2 == 1, "newstories").otherwise("topstories")
    return _hn(spark, sf_dir, which == hn.feed_list(F.lit("askhn")), limit=2000, feed="askhn", min_score=5)


@query
def first_n_per_source(spark, sf_dir):
    """The first items of each source, up to a limit that differs by source."""
    items = _raw(spark, sf_dir)
    limit = F.when(F.col("fetch_method") == "rss", 7).when(F.col("fetch_method") == "telegram_api", 5).otherwise(3)
    kept = first_n(items, ["source_id"], [F.col("arrival")], limit, 7)
    return kept.select("source_id", "arrival")

