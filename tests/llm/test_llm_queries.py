"""Queries with a counterpart in SQL, and what the entry registers."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from signal_lake.llm import catalog

TABLES = "documents pages conversations".split()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, small_sf, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_sf}/{table}.parquet'")
    result = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in result.description]
    frame = catalog.QUERIES[name](spark, small_sf)
    assert sorted(frame.columns) == sorted(columns)
    want = Counter(tuple(sorted(zip(columns, map(str, row), strict=True))) for row in result.fetchall())
    assert Counter(tuple(sorted((k, str(v)) for k, v in row.asDict().items())) for row in frame.collect()) == want
    assert want


def test_the_entry_has_all_operators_and_the_pipeline():
    names = {n for n in entry.queries() if re.match(r"op\d+_", n)}
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names} == set(range(1, len(names) + 1)) and "pipeline" in entry.queries()
    assert set(catalog.ORACLES) <= set(entry.oracle_sql())


def test_no_query_runs_row_pieces_through_one_partition(spark, small_sf):
    for name in ("op1_chat_format", "op3_quality_rules", "op7_sentencepiece", "op10_html_extraction"):
        plan = catalog.QUERIES[name](spark, small_sf)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan
