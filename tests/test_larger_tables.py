"""Queries and steps on more rows than the small tables hold: the same rows as SQL, and no task that takes a key whole."""

import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from riskweave.functions import history, stats
from riskweave.models import learn
from riskweave.plans import ORACLES, QUERIES
from riskweave.session import materialize


def test_stream_percentiles_of_a_busy_hour_equal_sql(spark, tmp_path):
    """25,182 records in one hour, six times what a sketch keeps."""
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    hour = spark.read.parquet("/root/testdata/sf0.1/events.parquet").where(F.hour("ts") == 13)
    events = hour.crossJoin(spark.range(6).withColumnRenamed("id", "_copy"))
    events = events.withColumn("event_id", F.col("event_id") + 100_000 * F.col("_copy")).drop("_copy")
    events.coalesce(1).write.parquet(f"{tmp_path}/one")
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "events.parquet")
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    assert compare(spark, con, "stream_latency_percentiles", str(tmp_path), QUERIES, ORACLES) is None


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 20, "chunk_rows": 7}])
def test_discrete_percentiles_equal_sorted_rows(spark, sizes):
    rng = np.random.default_rng(3)
    values = {0: rng.integers(0, 60, 5_000), 1: rng.integers(0, 5, 100), 2: np.array([7]), None: rng.integers(0, 9, 40)}
    rows = [(g, int(v), 1) for g, xs in values.items() for v in xs] + [(0, None, 3), (5, None, 2)]
    counts = spark.createDataFrame(rows, "g int, v int, n long")
    probs = {"least": 0.0, "p50": 0.5, "p99": 0.99, "most": 1.0}
    got = {r["g"]: r for r in stats.discrete_percentiles(counts, probs, ["g"], "v", **sizes).collect()}
    assert set(got) == {*values, 5} and tuple(got[5]) == (5, 0, None, None, None, None)
    for g, xs in values.items():
        want = [sorted(xs)[max(1, -(-len(xs) * round(100 * p) // 100)) - 1] for p in probs.values()]
        assert list(got[g])[1:] == [len(xs), *want]
    whole = stats.discrete_percentiles(counts, {"p": 0.5}, (), "v", **sizes)
    assert whole.columns == ["count", "p"] and whole.first()["count"] == 5_141


def test_hot_keys_are_not_brought_together_by_a_join(spark, capsys, monkeypatch):
    """No size limit and no adaptive step may be needed to keep a key's rows out of one task, as in a micro-batch."""
    plans, written = [], history.materialize

    def noted(df):
        df.explain()
        plans.append(capsys.readouterr().out)
        return written(df)

    monkeypatch.setattr(history, "materialize", noted)
    df = spark.range(2_000).select((F.col("id") % 2).alias("user"), F.col("id").alias("t"), "id")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = history.before(df, ["user"], "t", "id", [history.Measure("n", F.lit(1))], hot_rows=500, chunk_rows=100)
        out.explain()
        plans.append(capsys.readouterr().out)
        assert out.where("n <> floor(id / 2)").count() == 0 and out.count() == 2_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(plans) == 2 and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p and "ShuffledHashJoin" not in p for p in plans)


def test_percentiles_work_their_input_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def noted(x):
        seen.add(1)
        return x

    df = spark.range(0, 10_000, 1, 4).select(F.udf(noted, "double")(F.col("id").cast("double")).alias("x"))
    found = stats.exact_percentiles_of(df, ["x"], {"p": 0.95}).first()
    assert (found["count"], found["p"]) == (10_000, pytest.approx(0.95 * 9_999))
    assert seen.value == 10_000


def test_split_does_not_bring_a_label_together(spark, capsys):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1_000).select(F.col("id").alias("transaction_id"), (F.col("id") % 2 == 0).alias("is_fraud"))
        learn.stratified_split(rows).explain()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_percentile_and_result_share_one_join(spark, small, monkeypatch):
    """The result reads the table the percentile was taken from, which is not written a second time."""
    written = []
    monkeypatch.setattr(stats, "materialize", lambda df: written.append(df.columns) or materialize(df))
    made = QUERIES["high_amount_p95"](spark, small)
    assert not any("lineitem" in name or "orders" in name for name in made.inputFiles())
    assert written == [["cell", "value", "n"]]
    assert compare(spark, duck(small), "high_amount_p95", small, QUERIES, ORACLES) is None
