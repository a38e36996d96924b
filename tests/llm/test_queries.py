"""The registered queries: those with SQL equal DuckDB, all run over their whole tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as driver
import corpus_pipeline
from riskweave.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_sql(spark, con, small, name):
    assert compare(spark, con, name, small, QUERIES, ORACLES) is None


@pytest.mark.parametrize("name", ["op3_toxicity", "op4_sharding", "op5_token_counts", "op12_fill_in_middle"])
def test_a_row_for_every_document(spark, small, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, small).select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect())


def test_the_entry_has_all_text_queries():
    names = set(driver.queries())
    assert set(QUERIES) | {"pipeline"} <= names and len(QUERIES) == 13
    assert set(ORACLES) <= set(driver.oracle_sql()) and driver.queries()["pipeline"] is corpus_pipeline.run
