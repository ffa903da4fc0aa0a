"""The registered queries over the given tables."""

from __future__ import annotations

import os

import pytest
from compare import differences, duck

from windgrid.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    found, rows, *_ = differences(spark, duck(SF_DIR), queries.QUERIES[name], queries.ORACLES[name], SF_DIR)
    assert not found
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_has_a_row_for_each_row_of_its_table(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    table = "pages" if name == "op8_pages" else "documents"
    key = "page_id" if name == "op8_pages" else "doc_id"
    assert {r[0] for r in got.select(key).collect()} == {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
