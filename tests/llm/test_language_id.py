"""Naive Bayes against a plain count, accuracy on held-out documents."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from signal_lake.llm import language_id as L
from signal_lake.llm.catalog import QUERIES


def found(text):
    return [int(x) for part in L.features(text) for x in part]


def plain_model(rows):
    counts = defaultdict(Counter)
    for text, label in rows:
        if text is not None and label is not None:
            counts[label].update(found(text))
    return {k: (c, sum(c.values()) + L.ALPHA * (1 << L.BITS)) for k, c in counts.items()}


def plain_scores(model, text):
    logs = {k: sum(math.log((c[x] + L.ALPHA) / total) for x in found(text)) for k, (c, total) in model.items()}
    top = max(logs.values())
    whole = sum(math.exp(v - top) for v in logs.values())
    return {k: math.exp(v - top) / whole for k, v in logs.items()}


def test_features_are_all_grams_whatever_the_blocks():
    text = "Grüße, WORLD! 日本"
    assert len(found(text)) == sum(max(0, len(text.lower()) - n) for n in range(3))
    whole = sorted(found(text))
    for block in (1, 2, 3, 5):
        assert sorted(int(x) for part in L.features(text, block=block) for x in part) == whole
    assert found("") == [] and len(found("a")) == 1


def test_accuracy_on_held_out_documents(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "lang", "text")
    rows = QUERIES["op5_language_id"](spark, small_sf).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    model = plain_model([(r.text, r.lang) for r in rows if not r.held_out])
    for r in rows[:60]:
        scores = plain_scores(model, r.text)
        assert r.lang_pred == max(sorted(scores), key=scores.get)
        assert abs(r.score - scores[r.lang_pred]) < 1e-3


def test_odd_documents(spark, odd_docs, no_docs):
    rows = L.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    for doc_id in (2, 3, 4, 6):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "und"} and all(0 <= r.score <= 1 for r in rows)
    assert None in by_id and by_id[5].lang is None and by_id[5].lang_pred != "und"
    assert L.identify(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", odd_docs.lang.substr(9, 1)).where("lang = 'x' OR doc_id = 1").replace("", None, ["lang"])
    assert {(r.lang_pred, r.score) for r in L.identify(unlabelled).collect()} == {("und", 0.0)}


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(0, "abc", "y"), (1, "abc", "x"), (2, "abc", None)], "doc_id int, text string, lang string")
    languages, matrix = L.train(docs, "text", "lang")
    assert languages == ["x", "y"] and np.array_equal(matrix[0], matrix[1])
    assert {(r.lang_pred, round(r.score, 6)) for r in L.predict(docs, "text", languages, matrix).collect()} == {("x", 0.5)}
