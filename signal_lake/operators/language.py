"""Language detection by character trigrams, trained on labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signal_lake.session import stage

# Trigrams are counted in this many places, all of them: the model has at most so many rows a language.
PLACES = 1 << 16
# With at most this many languages (ISO 639-1 has fewer) the table that scoring broadcasts is under 55 MB; with four, 1 MB.
MAX_LANGUAGES = 200
MIN_LENGTH = 20
BATCH_BYTES = 8 << 20
# Counts are scaled to this total per language before smoothing, so that all languages weigh alike.
_SCALE = 1_000_000


def _bounded(rows: DataFrame) -> DataFrame:
    """The same rows; Arrow batches hold at most 8 MB, so a Python worker holds little even if texts are long."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows


def _places_of() -> Callable[[str], np.ndarray]:
    """A function for tasks: the places of all overlapping runs of three characters of a text, from their code points.

    What tasks run is made inside functions, so it travels with the job and no worker has to import this package.
    """

    def places_of(text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        return (points[:-2] * 7919 + points[1:-1] * 127 + points[2:]) % PLACES

    return places_of


def count_trigrams(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """Rows (lang, place, n): how often the trigrams of a language's texts fall into each place. Counts of parts add up to those of the whole.

    A task counts its batches of texts as arrays; only the counts are shuffled.
    """
    places_of = _places_of()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                texts.setdefault(name, []).append(places_of(value.as_py()))
            for name, found in texts.items():
                counts = np.bincount(np.concatenate(found), minlength=PLACES)
                places = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(counts[places], pa.int64())], ["lang", "place", "n"])

    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    lowered = _bounded(known.select(F.col(lang).alias("lang"), F.lower(text).alias("text")))
    return lowered.mapInArrow(count, "lang string, place bigint, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))


def add_counts(*counts: DataFrame) -> DataFrame:
    """The counts of all texts that went into ``counts``."""
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("lang", "place").agg(F.sum("n").alias("n"))


def profile_of(counts: DataFrame) -> DataFrame:
    """Rows (place, lang, weight): the weight of every place that a language's trigrams fall into, as a small staged table.

    The weight is a rounded thousandfold log of the add-one smoothed count: sums of whole numbers
    do not depend on the order of rows.
    """
    counts = stage(counts, "trigram_counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    weight = F.round(1000 * F.log(1 + F.lit(_SCALE) * F.col("n") / F.col("total"))).cast("bigint")
    return stage(counts.join(totals, "lang").select("place", "lang", weight.alias("weight")), "language_profile")


def train_profile(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """The profile of labelled texts."""
    return profile_of(count_trigrams(labelled, text, lang))


def detect(rows: DataFrame, key: str, text: str, profile: DataFrame) -> DataFrame:
    """Rows (key, detected); texts under 20 characters or without a known trigram are left out.

    The profile is a table of a weight per place and language, broadcast to the tasks; they look up the places of a whole text and add
    the weights, so nothing is shuffled. ``profile`` must come from ``profile_of``, which bounds its size by ``PLACES``.
    """
    langs = sorted(row.lang for row in profile.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if not langs:
        return rows.select(key, F.lit(None).cast("string").alias("detected")).limit(0)
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"the profile has more than {MAX_LANGUAGES} languages")
    table = np.zeros((PLACES, len(langs)), dtype=np.int32)
    entries = profile.select("place", F.array_position(F.lit(langs), F.col("lang")).cast("int").alias("lang"), F.col("weight").cast("int").alias("weight")).toArrow()
    table[entries["place"].to_numpy(), entries["lang"].to_numpy() - 1] = entries["weight"].to_numpy()
    known = np.zeros(PLACES, dtype=bool)
    known[entries["place"].to_numpy()] = True
    shared = rows.sparkSession.sparkContext.broadcast((langs, table, known))
    places_of = _places_of()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, met = shared.value
        for batch in batches:
            found: list[str | None] = []
            for value in batch.column(1):
                counts = np.bincount(places_of(value.as_py()), minlength=PLACES)
                places = np.flatnonzero(counts)
                if not met[places].any():
                    found.append(None)
                    continue
                scores = counts[places] @ weights[places].astype(np.int64)
                found.append(names[int(np.flatnonzero(scores == scores.max())[-1])])  # of equal scores the last name counts
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "detected"])

    asked = _bounded(rows.where(F.length(text) >= MIN_LENGTH).select(key, F.lower(text).alias("text")))
    kind = asked.schema[0].dataType.simpleString()
    return asked.mapInArrow(best, f"`{key}` {kind}, detected string").where(F.col("detected").isNotNull())
