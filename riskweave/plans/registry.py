"""Named queries: a DataFrame function per name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskweave.session import tune
from riskweave.sources.tables import PAY_SQL, TXN_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(tune(spark), folder)

        run.__name__, run.__module__ = name, build.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _with_views(views: str, body: str) -> str:
    body = body.strip()
    joined = f",\n{body[5:]}" if body.startswith("WITH ") else f"\n{body}"
    return f"WITH {views}{joined}"


def txn(body: str) -> str:
    """SQL over the transactions view; `body` may start with its own WITH list."""
    return _with_views(TXN_SQL, body)


def pay(body: str) -> str:
    return _with_views(PAY_SQL, body)


# SQL snippets shared by the statements below.
def iso_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def money_sql(amount: str) -> str:
    return f"CAST(CASE WHEN isfinite(CAST({amount} AS DOUBLE)) THEN {amount} END AS DECIMAL(24,6))"


def money_sum_sql(amount: str) -> str:
    return f"CAST(sum({money_sql(amount)}) AS DOUBLE)"


def money_avg_sql(amount: str) -> str:
    return f"({money_sum_sql(amount)} / nullif(count({money_sql(amount)}), 0))"
