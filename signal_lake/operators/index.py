"""A stored index of keys and fingerprints: a batch reads only the folders that may hold its own.

Each run adds its entries: rows (kind, source_id, external_content_id, content_hash, place) in folders by ranges of a hash, and a filter,
64-bit words in which every entry has set four bits of the word its hash names. A batch looks its own words up in the filters; only folders
with a word that has all bits of some item of the batch are read, and only for these the exact keys are compared. What a run adds
depends on that run alone, and ``merge`` turns the runs so far into one, so that filters stay few.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signal_lake.session import stage

KEY = ["source_id", "external_content_id"]
ENTRIES = "kind string, source_id string, external_content_id string, content_hash string, member bigint, place bigint"
#: Entries of a folder, and entries per word of the filter: 16 bits each, of which 4 are set.
FOLDER, PER_WORD = 1 << 20, 4


def _placed(rows: DataFrame) -> DataFrame:
    """Entries with ``place``, a hash of what they are looked up by."""
    place = F.when(F.col("kind") == "key", F.xxhash64("kind", *KEY)).otherwise(F.xxhash64("kind", "content_hash"))
    return rows.withColumn("place", place)


def entries_of(rows: DataFrame) -> DataFrame:
    """One entry per different key and per different fingerprint; NULL ones are never looked for."""
    missing, nobody = F.lit(None).cast("string"), F.lit(None).cast("bigint").alias("member")
    keys = rows.where(F.col("external_content_id").isNotNull() & F.col("source_id").isNotNull()).select(F.lit("key").alias("kind"), *KEY, missing.alias("content_hash"), nobody)
    prints = rows.where(F.col("content_hash").isNotNull()).select(F.lit("hash").alias("kind"), missing.alias("source_id"), missing.alias("external_content_id"), "content_hash", nobody)
    return _placed(keys.union(prints).distinct())


def members_of(rows: DataFrame, order: str) -> DataFrame:
    """Two entries a row, by its key and by its fingerprint, each with the whole row and its ``order`` as ``member``."""
    kinds = F.explode(F.array(F.lit("key"), F.lit("hash"))).alias("kind")
    both = rows.select(kinds, *KEY, "content_hash", F.col(order).cast("bigint").alias("member"))
    findable = F.when(F.col("kind") == "key", F.col("external_content_id").isNotNull() & F.col("source_id").isNotNull()).otherwise(F.col("content_hash").isNotNull())
    return _placed(both.where(findable))


def _word(place: Column, words: Column | int) -> Column:
    """Number of the word of an entry among ``words``."""
    return F.pmod(F.shiftrightunsigned(place, 8), F.lit(words) if isinstance(words, int) else words)


def _bits(place: Column) -> Column:
    """The four bits of an entry in its word."""
    mixed = F.xxhash64(place)
    found = F.lit(0).cast("bigint")
    for k in range(4):
        at = F.pmod(F.shiftrightunsigned(mixed, 6 * k), F.lit(64)).cast("int")
        found = found.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return found


@dataclass(frozen=True)
class StoredIndex:
    """The index under ``root`` as of some runs."""

    spark: SparkSession
    root: str
    runs: tuple[int, ...]

    def add(self, rows: DataFrame, run: int) -> None:
        """Write what ``run`` adds; a run that is done again replaces its own."""
        self._write(stage(entries_of(rows), "index_entries"), run)

    def add_members(self, rows: DataFrame, order: str, run: int) -> None:
        """The same with every row as a member of its two groups."""
        self._write(stage(members_of(rows, order), "index_entries"), run)

    def _write(self, entries: DataFrame, run: int) -> None:
        count = entries.count()
        folders = max(1, -(-count // FOLDER))
        words = folders * max(1, -(-count // (folders * PER_WORD)))
        placed = entries.withColumn("word", _word(F.col("place"), words))
        folder = F.floor(F.col("word") * folders / words).cast("int")
        filters = placed.groupBy("word").agg(F.bit_or(_bits(F.col("place"))).alias("bits"))
        filters.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(f"{self.root}/filters/run={run}")
        by_folder = placed.withColumn("folder", folder).drop("word").repartition("folder")
        by_folder.write.mode("overwrite").partitionBy("folder").parquet(f"{self.root}/entries/run={run}")
        shape = self.spark.createDataFrame([(words, folders)], "words bigint, folders int")
        shape.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/shapes/run={run}")

    def folders_for(self, entries: DataFrame) -> list[tuple[int, int]]:
        """(run, folder) of all folders that may hold one of ``entries``; one pair of numbers each."""
        if not self.runs:
            return []
        shapes = self._read("shapes", "words bigint, folders int").collect()  # one row a run
        filters = self._read("filters", "word bigint, bits bigint")
        shape = F.explode(F.array(*[F.struct(*[F.lit(r[c]).cast(k).alias(c) for c, k in (("run", "bigint"), ("words", "bigint"), ("folders", "int"))]) for r in shapes]))
        asked = entries.select("place", shape.alias("s"))
        asked = asked.select("s.run", _word(F.col("place"), F.col("s.words")).alias("word"), _bits(F.col("place")).alias("wanted"), "s.words", "s.folders")
        met = asked.join(filters, ["run", "word"]).where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
        found = met.select("run", F.floor(F.col("word") * F.col("folders") / F.col("words")).cast("int").alias("folder")).distinct()
        return sorted((r["run"], r["folder"]) for r in found.collect())

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{part}/run={run}" for run in self.runs]
        return self.spark.read.schema(f"{schema}, run bigint").option("basePath", f"{self.root}/{part}").parquet(*paths)

    def read_folders(self, folders: list[tuple[int, int]]) -> DataFrame:
        """Entries of these folders; nothing else is listed or read."""
        if not folders:
            return self.spark.createDataFrame([], ENTRIES)
        paths = [f"{self.root}/entries/run={run}/folder={folder}" for run, folder in folders]
        return self.spark.read.schema(ENTRIES).parquet(*paths)

    def members(self, asked: DataFrame) -> DataFrame:
        """Stored rows (two key columns, content_hash, member) of the groups that ``asked`` entries name."""
        found = self.read_folders(self.folders_for(asked))
        same = F.col("f.place") == F.col("a.place")
        same = same & (F.col("f.kind") == F.col("a.kind"))
        # Of a hash that two groups share, the group itself decides.
        by_key = (F.col("f.kind") == "key") & F.col("f.source_id").eqNullSafe(F.col("a.source_id")) & F.col("f.external_content_id").eqNullSafe(F.col("a.external_content_id"))
        by_print = (F.col("f.kind") == "hash") & F.col("f.content_hash").eqNullSafe(F.col("a.content_hash"))
        return found.alias("f").join(asked.alias("a"), same & (by_key | by_print), "left_semi").select(*KEY, "content_hash", "member")

    def touched(self, items: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(stored keys, stored fingerprints) that ``items`` meet, each once."""
        asked = stage(entries_of(items), "asked")
        found = self.read_folders(self.folders_for(asked)).join(asked, "place", "left_semi")
        # Hashes of 64 bits may agree by chance, so the keys themselves decide.
        keys = found.where("kind = 'key'").select(*KEY).distinct().join(asked.where("kind = 'key'").select(*KEY), KEY, "left_semi")
        prints = found.where("kind = 'hash'").select("content_hash").distinct()
        return keys, prints.join(asked.where("kind = 'hash'").select("content_hash"), "content_hash", "left_semi")

    def merge(self, into: int) -> StoredIndex:
        """One run that holds the entries of all; the old ones stay until they are deleted."""
        if into in self.runs:
            raise ValueError(f"run {into} is one of those that are merged")
        whole = self._read("entries", ENTRIES).drop("run").distinct() if self.runs else self.spark.createDataFrame([], ENTRIES)
        self._write(stage(whole, "index_entries"), into)
        return StoredIndex(self.spark, self.root, (into,))
