"""Edge values of the row-wise rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.operators import aggregates as a, alerts, projections as p, ranking
from riskweave.schemas import TRANSACTION

INF = float("inf")


def values(spark, schema, data, column):
    df = spark.createDataFrame([(x,) for x in data], schema)
    return [r[0] for r in df.select(column).collect()]


def test_risk_classes_differ_on_their_limits(spark):
    scores = [None, 0, 29, 30, 60, 80, 95, 99, 100, 101]
    assert values(spark, "s int", scores, c.risk_level(F.col("s"))) == [
        "LOW", "LOW", "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "CRITICAL", "CRITICAL", "CRITICAL"]
    assert values(spark, "s int", scores, c.risk_category(F.col("s"))) == [
        None, None, "LOW", "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "CRITICAL", None]
    assert values(spark, "s int", [79, 80, 94, 95, None], c.severity(F.col("s"))) == [None, "high", "high", "critical", None]


def test_amount_classes(spark):
    amounts = [None, -1.0, 0.0, 300.0, 300.01, 500.0, 1000.0, 1000.01, INF]
    assert values(spark, "x double", amounts, c.amount_category(F.col("x"))) == [
        "LOW", "LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert values(spark, "x double", amounts, c.amount_bucket(F.col("x"))) == [
        None, None, None, "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert values(spark, "x double", [500.0, 500.01], c.is_high_amount(F.col("x"))) == [False, True]


def test_cross_border_of_nothing_is_false(spark):
    assert values(spark, "r string", ["APAC", "LATAM", "ME-AF", "EU-WEST", None], c.is_cross_border(F.col("r"))) == [
        True, True, True, False, False]


def test_clean_numeric(spark):
    got = values(spark, "x double", [INF, -INF, float("nan"), None, 2.5], c.finite_or_zero(F.col("x")))
    assert got == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_ids_keep_long_numbers(spark):
    got = values(spark, "n long", [1, 1234567, 123456789], c.padded_id("TXN-", F.col("n"), 7))
    assert got == ["TXN-0000001", "TXN-1234567", "TXN-123456789"]


def test_new_destination_and_negative_balance(spark):
    df = spark.createDataFrame([(5.0, 10.0, 5.0, 0.0, 5.0), (5.0, -1.0, 0.0, 3.0, 8.0)],
                               "amount double, oldbalanceOrg double, newbalanceOrig double, oldbalanceDest double, newbalanceDest double")
    rows = p.balance_features(df).collect()
    assert [r["is_dest_new"] for r in rows] == [1, 0]
    assert rows[1]["amount_to_balance_ratio"] is None


def test_type_channel_and_step(spark):
    assert values(spark, "t string", ["CASH_IN", "DEBIT", "GIFT", None], c.type_channel(F.col("t"))) == ["MOBILE", "POS", None, None]
    assert values(spark, "s int", [0, 25], c.step_time(F.col("s"))) == [datetime(2024, 1, 1), datetime(2024, 1, 2, 1)]


def test_unreadable_json_and_time(spark):
    raw = spark.createDataFrame([('{"transaction_id": "a", "is_fraud": true, "amount": 1.5}',), ("{oops",)], "value string")
    rows = p.parse_transactions(raw, TRANSACTION).collect()
    assert [r["transaction_id"] for r in rows] == ["a", None]
    assert p.parse_transactions(raw, TRANSACTION, keep_unreadable=False).count() == 1
    assert values(spark, "t string", ["2024-05-01T10:00:00", "never"], c.event_time(F.col("t"))) == [datetime(2024, 5, 1, 10), None]


def test_alert_message_without_fraud_type(spark):
    df = spark.createDataFrame(
        [(1, None, 85, "Shop", 7, "APAC", datetime(2024, 1, 1), True)],
        "transaction_id long, fraud_type string, risk_score int, merchant string, user_id long, region string, ts timestamp, is_fraud boolean")
    row = alerts.alert_payload(df).first()
    assert row["message"] == "HIGH RISK: None detected on Shop"
    assert row["fraud_type"] == "unknown" and len(row["alert_id"]) == 8
    other = alerts.predictor_alert_payload(df).first()
    assert (other["fraud_type"], other["message"]) == ("Suspicious", "HIGH RISK: risk_score=85 for 7")


def test_filter_limits(spark):
    df = spark.range(5).select(F.col("id").alias("transaction_id"), F.current_timestamp().alias("ts"))
    for bad in (0, 501):
        with pytest.raises(ValueError):
            p.transaction_filter(df, limit=bad)
    with pytest.raises(ValueError):
        ranking.latest_alerts(df, limit=101)


def test_histogram_closes_the_last_bin_and_takes_a_constant_column(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 10)], "x double")
    assert {r["bin"]: r["count"] for r in a.histogram(df, "x", 10).collect()} == {0: 1, 1: 1, 2: 1, 3: 1, 9: 1}
    same = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [tuple(r) for r in a.histogram(same, "x", 10).collect()] == [(5, 2)]


def test_correlation_with_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, True), (2.0, 5.0, False), (3.0, 5.0, True)], "x double, k double, is_fraud boolean")
    got = {r["feature"]: r["r"] for r in a.correlation_with_label(df, ["x", "k"]).collect()}
    assert got["k"] is None and got["x"] == pytest.approx(0.0)


@pytest.mark.parametrize("n", [1, 7, 500, 5000])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(2000).withColumnRenamed("id", "transaction_id")
    first = {r[0] for r in ranking.sample_rows(df, n).collect()}
    again = {r[0] for r in ranking.sample_rows(df.repartition(13), n).collect()}
    assert len(first) == min(n, 2000) and first == again


def test_recent_rows_are_ranked_before_the_exchange(spark, small):
    from riskweave.operators.running import recent_per_key
    from riskweave.sources.tables import transactions

    rows = recent_per_key(transactions(spark, small, region=False), ["merchant"], 5)
    assert "WindowGroupLimit" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.groupBy("merchant").count().agg(F.max("count")).first()[0] == 5


def test_money_sums_are_exact_in_any_order_and_size(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    rng = random.Random(5)
    sound = [round(rng.uniform(-1e6, 1e6), rng.randint(0, 6)) for _ in range(3000)] + [9.5e17] * 60 + [-1e17, 0.1, -0.000001]
    rows = [(1, x) for x in sound] + [(1, x) for x in (None, INF, -INF, float("nan"), 1e18)] + [(2, None), (2, INF)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, x double").repartition(7)
    exact = sum(Decimal(repr(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP) for x in sound)
    x = F.col("x")
    got = {r["k"]: r for r in df.groupBy("k").agg(c.money_sum(x).alias("s"), c.money_avg(x).alias("m"), c.money_sum(x, 2).alias("c")).collect()}
    assert got[1]["s"] == float(exact) and got[1]["m"] == float(exact) / len(sound)
    assert got[1]["c"] == pytest.approx(float(exact)) and got[2]["s"] is None and got[2]["m"] is None
    paid = spark.createDataFrame([(Decimal("-12.34567800"),), (Decimal("3.10000000"),)], "x decimal(30,8)")
    assert paid.agg(c.money_sum(x)).first()[0] == -9.245678
