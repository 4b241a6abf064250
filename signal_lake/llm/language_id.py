"""Language identification: multinomial naive Bayes over hashed character n-grams.

Method: texts are lower-cased and each of their 1- to 3-grams of code points is hashed into one of ``2 ** bits``
features. Training counts features per language in numpy, batch by batch; Spark sums the counts, and a task per
language turns them into log probabilities with additive smoothing. The matrix (languages x features, 4 bytes each) is
broadcast; its size depends on the number of languages alone and is checked. Scoring sums the log probabilities of
the features a text has, and only of those, batch by batch, over the whole text. The probability says which learned language is
nearest, however far: ``check_fit`` also holds a text's mean log probability per n-gram against what nearly all training texts of
the predicted language have, and makes a text below that ``und``.

Results for odd input: a NULL text, a text without a letter, and every text when nothing could be learned
are ``und`` with score 0. Rows with a NULL label or text teach nothing. Equal scores go to the language that sorts first.
Repeated rows count as often as they occur. Columns other than id, text and label are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.llm.common import as_column, map_batches, prepare, schema_of

BITS = 16
ALPHA = 0.5
UNKNOWN = "und"
#: Bound of the broadcast matrix: 1,000 languages at 16 bits.
MODEL_BYTES = 256 << 20
#: A text fits if its mean is not below this quantile of the training texts' by more than MARGIN + SPREAD / root of its n-grams:
#: texts that were not learned from fit less well, and few n-grams vary more.
FIT_QUANTILE, MARGIN, SPREAD = 0.01, 0.25, 10.0
_LETTER = re.compile(r"[^\W\d_]")
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def features(text: str, bits: int = BITS, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """Feature numbers of all 1-, 2- and 3-grams of the lower-cased text, by blocks of their last code point."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    shift = np.uint64(64 - bits)
    for start in range(0, len(points), block):
        for n in range(min(3, start + block, len(points))):
            part = points[max(0, start - n) : start + block].astype(np.uint64) + np.uint64(1)
            if len(part) <= n:
                continue
            mixed = part[: len(part) - n] * _STEPS[0]
            for k in range(1, n + 1):
                mixed = mixed * np.uint64(31) + part[k : len(part) - n + k] * _STEPS[k]
            mixed *= _SPREAD
            mixed ^= mixed >> np.uint64(32)
            mixed *= _SPREAD
            yield (mixed >> shift).astype(np.int64)


def train(labelled: DataFrame, text_column: Column | str, label_column: Column | str, bits: int = BITS, alpha: float = ALPHA) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log probabilities, one row each."""
    prepare(labelled.sparkSession)
    size = 1 << bits
    rows = labelled.select(as_column(text_column).alias("text"), as_column(label_column).cast("string").alias("label"))
    rows = rows.where("text IS NOT NULL AND label IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = totals.setdefault(label, np.zeros(size, dtype=np.int64))
                for found in features(text, bits):
                    np.add.at(total, found, 1)
        for label, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([label] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])], ["label", "feature", "n"])

    counts = rows.mapInArrow(count, "label string, feature int, n bigint").groupBy("label", "feature").agg(F.sum("n").alias("n"))

    def weigh(counted: pd.DataFrame) -> pd.DataFrame:
        dense = np.full(size, alpha)
        dense[counted["feature"].to_numpy()] += counted["n"].to_numpy()
        weights = np.log(dense / dense.sum()).astype(np.float32)
        return pd.DataFrame({"label": [counted["label"].iloc[0]], "weights": [weights.tobytes()]})

    # A language has at most 2 ** bits rows here, so neither a group nor what goes to the driver grows with the texts.
    vectors = counts.groupBy("label").applyInPandas(weigh, "label string, weights binary")
    rows_ = sorted(vectors.limit(MODEL_BYTES // (4 * size) + 1).collect(), key=lambda r: r["label"])
    if len(rows_) * 4 * size > MODEL_BYTES:
        raise ValueError("too many languages for the broadcast; use fewer bits")
    matrix = np.stack([np.frombuffer(r["weights"], dtype=np.float32) for r in rows_]) if rows_ else np.zeros((0, size), np.float32)
    return [r["label"] for r in rows_], matrix


def fit_floors(labelled: DataFrame, text_column: Column | str, label_column: Column | str, languages: list[str], matrix: np.ndarray, bits: int = BITS) -> np.ndarray:
    """By language, the ``FIT_QUANTILE`` of its training texts' mean log probabilities per n-gram."""
    prepare(labelled.sparkSession)
    rows = labelled.select(as_column(text_column).alias("text"), as_column(label_column).cast("string").alias("label"))
    rows = rows.where("text IS NOT NULL AND label IS NOT NULL")
    model = labelled.sparkSession.sparkContext.broadcast((languages, matrix))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, weights = model.value
        numbers = {name: i for i, name in enumerate(names)}
        labels, means = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total, n = 0.0, 0
            for found in features(text, bits):
                total += float(weights[numbers[label]].take(found).sum(dtype=np.float64))
                n += len(found)
            if n:
                labels.append(label)
                means.append(total / n)
        return pa.record_batch([pa.array(labels, pa.string()), pa.array(means, pa.float64())], ["label", "mean"])

    found = map_batches(rows, measure, "label string, mean double").groupBy("label").agg(F.percentile_approx("mean", FIT_QUANTILE, 10_000).alias("floor"))
    floors = {r["label"]: r["floor"] for r in found.collect()}
    return np.array([floors[name] for name in languages])


def predict(docs: DataFrame, text_column: Column | str, languages: list[str], matrix: np.ndarray, bits: int = BITS, floors: np.ndarray | None = None) -> DataFrame:
    """``docs`` with lang_pred and score, the probability of that language by the model; columns of these names are replaced.

    With ``floors``, texts that don't fit the predicted language are ``und`` with score 0.
    """
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast((languages, matrix))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, weights = model.value
        labels, scores = [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            if text is None or not names or not _LETTER.search(text):
                labels.append(UNKNOWN)
                scores.append(0.0)
                continue
            total, n = np.zeros(len(names)), 0
            for found in features(text, bits):
                n += len(found)
                total += [row.take(found).sum(dtype=np.float64) for row in weights]
            best = int(np.argmax(total))
            if floors is not None and total[best] / n < floors[best] - MARGIN - SPREAD / np.sqrt(n):
                labels.append(UNKNOWN)
                scores.append(0.0)
                continue
            labels.append(names[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        return pa.record_batch([*kept, pa.array(labels, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], as_column(text_column).alias("_scored"))
    return map_batches(rows, score, schema_of(rows, kept, "lang_pred string, score double"))


def held_out(id_column: Column | str) -> Column:
    """Rows that the model may not learn from: one part in three, by a hash of the id."""
    return F.coalesce(F.crc32(as_column(id_column).cast("string")) % 3 == 1, F.lit(False))


def identify(
    docs: DataFrame, id_column: Column | str = "doc_id", text_column: Column | str = "text", label_column: Column | str = "lang", check_fit: bool = False
) -> DataFrame:
    """``docs`` with held_out, lang_pred and score, by a model of the rows that are not held out."""
    marked = docs.withColumn("held_out", held_out(id_column))
    taught = marked.where(~F.col("held_out"))
    languages, matrix = train(taught, text_column, label_column)
    floors = fit_floors(taught, text_column, label_column, languages, matrix) if check_fit and languages else None
    return predict(marked, text_column, languages, matrix, floors=floors)
