"""Every registered query with SQL gives the rows DuckDB gives for that SQL."""

import pytest
from compare import compare, duck

from riskweave.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_sql(spark, con, small, name):
    problem = compare(spark, con, name, small, QUERIES, ORACLES)
    # A quiet table may legitimately have no rows for a thresholded report.
    assert problem in (None, "no rows"), problem


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_stable_schema(spark):
    import __spark_entry__ as driver

    first, second = driver.entry(spark), driver.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 1000
    assert set(driver.oracle_sql()) <= set(driver.queries())
