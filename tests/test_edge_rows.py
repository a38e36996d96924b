"""Rows without a time, amounts that are no numbers, unknown customers, text ids, and frames of any length."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.models import ensemble as e, learn
from riskweave.operators import aggregates as a, alerts, features as f, joins as j, ranking as k, running as r
from riskweave.sources import tables
from riskweave.sources.stores import AlertStore

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark, small):
    """Transactions with all kinds of bad values mixed in."""
    rows = tables.transactions(spark, small).where("transaction_id < 300")
    bad = rows.where("transaction_id < 12").withColumn("transaction_id", F.col("transaction_id") + 10_000)
    n = F.col("transaction_id") % 4
    bad = bad.withColumn("amount", F.when(n == 0, NAN).when(n == 1, INF).when(n == 2, -INF).otherwise(0.004))
    bad = bad.withColumn("ts", F.when(n == 3, F.lit(None)).otherwise(F.col("ts"))).withColumn("region", F.lit(None).cast("string"))
    return rows.unionByName(bad.withColumn("channel", F.lit("wire")))


def test_money_is_exact_and_leaves_out_what_is_no_number(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 0.001, 0.004, NAN, INF, -INF, 1e30, None)], "amount double")
    got = df.agg(c.money_sum(F.col("amount")), c.money_avg(F.col("amount"))).first()
    assert got[0] == 3.005 and math.isclose(got[1], 3.005 / 4)


@pytest.mark.parametrize("build", [
    lambda t: f.transaction_features(t), lambda t: f.velocity(t), lambda t: f.amount_ratio(t), lambda t: f.channel_frequency(t),
    lambda t: f.geo_anomaly(t), lambda t: f.device_match(t), lambda t: f.time_since_second_last(t), lambda t: r.throughput(t),
    lambda t: r.trailing_latency(t, 50, block=7), lambda t: j.merchant_risk_asof(t),
])
def test_features_keep_every_row(odd, build):
    assert build(odd).count() == odd.count()


@pytest.mark.parametrize("build", [
    a.overall_stats, a.merchant_ranking, a.kpi_summary, a.volume_share, a.dashboard_metrics, j.user_stats, a.etl_batch_stats,
    lambda t: a.describe_numeric(t, ["amount"]), lambda t: a.histogram(t, "amount", 5), a.risk_rank,
])
def test_summaries_take_bad_amounts(odd, build):
    assert build(odd).count() > 0


def test_no_nan_in_sums_bins_and_quartiles(odd):
    sound = odd.where(c.is_finite(F.col("amount")))
    assert a.kpi_summary(odd).first()["avg_amount"] == a.kpi_summary(sound).first()["avg_amount"]
    assert a.histogram(odd, "amount", 5).agg(F.sum("count")).first()[0] == sound.count()
    assert a.describe_numeric(odd, ["amount"]).first()["count"] == odd.where(~F.isnan("amount")).count()


def test_a_row_without_a_time_is_nobodys_past(odd):
    counted = f.velocity(odd, 24 * 365 * 50).where("ts IS NOT NULL")
    whole = f.velocity(odd.where("ts IS NOT NULL"), 24 * 365 * 50)
    assert sorted(map(tuple, counted.select("transaction_id", "velocity_438000h").collect())) == sorted(
        map(tuple, whole.select("transaction_id", "velocity_438000h").collect()))


def test_cells_outside_the_listed_values_are_there(odd):
    pivot = a.rate_pivot(odd, "region", "channel", ["web", "click"])
    assert {"web", "click", "wire"} <= set(pivot.columns) and pivot.where("region IS NULL").first()["wire"] is not None
    grid = j.grid_complete(odd, "region", "channel", ["ASIA"], ["click", "fax"])
    assert grid.agg(F.sum("total")).first()[0] == odd.count()
    assert grid.where("region IS NULL AND channel = 'wire'").first()["total"] == 12
    assert grid.where("region = 'ASIA' AND channel = 'fax'").first()["total"] == 0


def test_an_unknown_customer_changes_no_row_count(spark, small, tmp_path):
    for name in ("customer", "nation", "region", "events", "orders", "lineitem", "supplier"):
        df = spark.read.parquet(f"{small}/{name}.parquet")
        df = df.where("c_custkey <> 7") if name == "customer" else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    folder = str(tmp_path)
    assert tables.transactions(spark, folder).count() == tables.transactions(spark, folder, region=False).count() == 1000
    assert tables.payments(spark, folder).count() == tables.payments(spark, folder, balances=False).count()


def test_batches_of_text_ids(spark):
    rows = [(f"TXN-{i:07d}", i % 3 == 0, i) for i in range(250)]
    stats = {x["batch"]: x["total"] for x in a.etl_batch_stats(spark.createDataFrame(rows, "transaction_id string, is_fraud boolean, risk_score int")).collect()}
    assert stats == {0: 100, 1: 100, 2: 50}


def test_huge_probabilities_stay_within_limits(spark):
    df = spark.createDataFrame([(-1e12,), (1e300,), (0.5,), (None,)], "amount double")
    points = [x["predicted_risk"] for x in e.fallback_score(df.withColumn("amount", F.col("amount") * 1000)).collect()]
    assert points == [0, 99, 50, None]


@pytest.mark.parametrize("last, block", [(10_000, 4096), (11, 5), (5, 5)])
def test_trailing_mean_over_frames_longer_than_a_block(spark, last, block):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=i), (i * 37) % 101) for i in range(12_000 if last > 100 else 60)]
    got = r.trailing_latency(spark.createDataFrame(rows, "transaction_id int, ts timestamp, processing_ms int"), last, block=block)
    ms, total, want = [x[2] for x in rows], 0, {}
    for i, x in enumerate(ms):
        total += x - (ms[i - last] if i >= last else 0)
        want[i] = total / min(i + 1, last)
    assert {x["transaction_id"]: x["avg_latency_ms"] for x in got.collect()} == pytest.approx(want)


def test_many_recent_rows_of_a_hot_key(spark):
    df = spark.range(0, 20_000, 1, 6).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 3 == 0).cast("int").alias("user_id"), F.timestamp_seconds(F.col("id") % 977).alias("ts"))
    got = r.recent_per_key(df, ["user_id"], 5000).collect()
    for user in (0, 1):
        mine = sorted(((i % 977, i) for i in range(20_000) if (i % 3 == 0) == user), reverse=True)[:5000]
        assert [x["transaction_id"] for x in sorted((x for x in got if x["user_id"] == user), key=lambda x: x["rank"])] == [i for _, i in mine]


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 10, "chunk_rows": 7}])
def test_places_of_a_whole_sort(spark, sizes):
    df = spark.range(100).select((F.col("id") * 7 % 13).alias("a"), "id")
    want = {i: n for n, (_, i) in enumerate(sorted((-(i * 7 % 13), i) for i in range(100)), start=1)}
    assert {x["id"]: x["place"] for x in k.placed(df, -F.col("a"), ["id"], **sizes).collect()} == want


def test_split_takes_the_same_share_of_each_label(spark):
    df = spark.range(1000).select(F.col("id").alias("transaction_id"), (F.col("id") % 100 == 0).alias("is_fraud"))
    parts = {(x["is_fraud"], x["split"]): x["count"] for x in learn.stratified_split(df).groupBy("is_fraud", "split").count().collect()}
    assert parts == {(True, "test"): 2, (True, "train"): 8, (False, "test"): 198, (False, "train"): 792}


def test_acknowledging_goes_by_transaction(spark):
    df = spark.createDataFrame([("same", 1, False), ("same", 2, False)], "alert_id string, transaction_id int, acknowledged boolean")
    marked = alerts.acknowledge(df, spark.createDataFrame([(2,)], "transaction_id int")).collect()
    assert {x["transaction_id"]: x["acknowledged"] for x in marked} == {1: False, 2: True}


def test_the_store_keeps_the_smallest_of_repeated_alerts(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path / "alerts"))
    rows = spark.createDataFrame([("t", 90, "b"), ("t", 81, "z"), ("t", 81, "a")], "transaction_id string, risk_score int, message string")
    store.append(rows.repartition(3))
    assert [(x["risk_score"], x["message"]) for x in spark.read.parquet(str(tmp_path / "alerts")).collect()] == [(81, "a")]
