"""The pipeline against a plain run of its stages."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline as P
from signal_lake.llm import language_id as L, packing

from odd_rows import CLASHING  # type: ignore[import-not-found]
from test_language_id import plain_model, plain_scores  # type: ignore[import-not-found]
from test_minhash_dedup import plain_components  # type: ignore[import-not-found]
from test_packing import check, tokenizer  # type: ignore[import-not-found]  # noqa: F401
from test_quality_rules import libraries, verdict  # type: ignore[import-not-found]  # noqa: F401


def plain_run(docs, libraries):  # noqa: F811
    """(doc_id, text) of the documents that reach the last stage."""
    model = plain_model([(d.text, d.lang) for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 != 1])

    def known(text):
        return bool(text and L._LETTER.search(text)) and max(plain_scores(model, text).values()) >= P.LEAST_SCORE

    docs = [d for d in docs if known(d.text)]
    docs = [d for d in docs if verdict(d.text, d.lang, libraries)[1]]
    docs.sort(key=lambda d: (d.doc_id is not None, d.doc_id))
    first = plain_components([d.text for d in docs])
    return [(d.doc_id, d.text) for i, d in enumerate(docs) if first[i] == i]


def test_run_against_a_plain_run(spark, small_sf, libraries, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").collect()
    want = plain_run(docs, libraries)
    check(P.run(spark, small_sf).collect(), want, tokenizer)
    assert 0 < len(want) < len(docs)


@pytest.mark.parametrize("stage", P.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_the_columns_and_survive_odd_documents(spark, odd_docs, no_docs, stage):
    _, function = stage
    kept = function(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns and dict(kept.dtypes) == dict(odd_docs.dtypes)
    assert not Counter(map(str, kept.collect())) - Counter(map(str, odd_docs.collect()))
    assert function(spark, no_docs, "").collect() == []


def test_one_document_of_each_group_stays(spark, odd_docs):
    kept = P.near_copies(spark, odd_docs, "").collect()
    ids = Counter(r.doc_id for r in kept)
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, None: 1, 5: 1, 6: 1, 7: 1, 8: 2, 9: 1, 10: 1, 12: 1})
    assert all(getattr(kept[0], name) == "clash" for name in CLASHING)


def test_stages_are_in_order():
    assert [name for name, _ in P.STAGES] == ["language", "quality", "near_copies", "packing"] and packing.SIZE == 1024


def test_texts_in_no_learned_language_go(spark, small_sf):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    strange = {
        -1: "Совет собрался в понедельник и решил построить мост через реку до начала зимы. ",
        -2: "評議会は月曜日に会合を開き、冬が始まる前に川に橋を架けることに同意した。",
        -3: "Rada zebrała się w poniedziałek i zgodziła się zbudować most na rzece przed początkiem zimy. ",
        -4: "".join(rng.choices(letters + letters.upper() + "0123456789+/", k=400)),
        -5: " ".join("".join(rng.choices(letters, k=6)) for _ in range(60)),
    }
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    more = spark.createDataFrame([(i, t * (4 if i > -4 else 1)) for i, t in strange.items()], "doc_id bigint, text string")
    kept = {r.doc_id for r in P.language(spark, docs.select("doc_id", "text", "lang").unionByName(more, allowMissingColumns=True), "").collect()}
    assert not kept & set(strange)
    labels = spark.read.parquet(f"{small_sf}/labels.parquet").where("quality = 1").join(docs, "doc_id", "left_semi").collect()
    assert labels and all(r.doc_id in kept for r in labels)
