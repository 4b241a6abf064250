from __future__ import annotations

import pytest

from odd_rows import CLASHING, ROWS  # type: ignore[import-not-found]

@pytest.fixture(scope="session")
def odd_docs(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string")
    docs = docs.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("bigint"))
    return docs.withColumns({name: F.lit("clash") for name in CLASHING})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
