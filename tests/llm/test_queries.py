"""The registered queries against their SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_points
from eventfares.llm.queries import ORACLE, QUERIES

from .. import compare

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", ORACLE)
def test_query_gives_what_its_sql_gives(spark, connection, name):
    rows, ours, theirs = compare.differences(QUERIES[name](spark, SMALL), connection, ORACLE[name])
    assert rows > 0
    assert not ours and not theirs, (ours[:3], theirs[:3])


def test_one_query_for_each_operator():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and n != "op12_conversation_repair"])
def test_queries_without_sql_have_a_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = QUERIES[name](spark, SMALL)
    assert found.select("doc_id").distinct().count() == documents.count()
