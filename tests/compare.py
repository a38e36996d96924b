"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/compare.py [folder] [name | @module ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (int, float)):
        return float(value)
    return value if value is None else str(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, name, folder, queries, oracles):
    """None when equal, else a short description of the difference."""
    df = queries[name](spark, folder)
    got = df.collect()
    if name not in oracles:
        return None if got else "no rows"
    cur = con.execute(oracles[name])
    columns = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, {sorted(columns)}: {bad[0][0]} vs {bad[0][1]}"
    there = {c[0]: SPARK_TYPE.get(str(c[1])) for c in cur.description}
    types = {n: (t, there[n]) for n, t in df.dtypes if t != there[n]}
    if types:
        return f"types {types}"
    return None if got else "no rows"


if __name__ == "__main__":
    from riskweave.plans import ORACLES, QUERIES
    from riskweave.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    modules = {w[1:] for w in wanted if w.startswith("@")}
    names = [n for n, q in QUERIES.items() if not wanted or n in wanted or q.__module__.split(".")[-1] in modules]
    if os.environ.get("PLAIN_SESSION"):  # a session nobody has tuned
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session(8)
    con = duck(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder, QUERIES, ORACLES)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{kind} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
