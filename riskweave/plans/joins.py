"""Join and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import joins as j
from riskweave.plans.features import MERCHANT_SQL
from riskweave.plans.registry import money_avg_sql, query, txn
from riskweave.schemas import EVENT_CHANNELS, GEO_REGIONS
from riskweave.sources.tables import transactions


def lean(spark, d):
    return transactions(spark, d, region=False)


def reviewed(rows):
    """Predictions for every second transaction id; the upper half has no transaction."""
    return rows.select(
        (F.col("transaction_id") * 2).alias("transaction_id"), (F.col("risk_score") / 100.0).alias("fraud_probability"))


@query("predictions_with_txn", txn("""WITH p AS (SELECT transaction_id * 2 AS transaction_id, risk_score / 100.0::DOUBLE AS fraud_probability FROM txn)
  SELECT p.transaction_id, fraud_probability, amount, is_fraud FROM p JOIN txn USING (transaction_id)"""))
def _(spark, d):
    rows = lean(spark, d)
    return j.predictions_with_transactions(reviewed(rows), rows.select("transaction_id", "amount", "is_fraud"))


@query("orphan_predictions", txn("""WITH p AS (SELECT transaction_id * 2 AS transaction_id, risk_score / 100.0::DOUBLE AS fraud_probability FROM txn)
  SELECT * FROM p WHERE transaction_id NOT IN (SELECT transaction_id FROM txn)"""))
def _(spark, d):
    rows = lean(spark, d)
    return j.orphan_predictions(reviewed(rows), rows)


@query("known_device", txn("""WITH k AS (SELECT DISTINCT user_id, device_id FROM txn WHERE status = 'CLEARED')
  SELECT transaction_id, CASE WHEN k.device_id IS NOT NULL THEN 0.0::DOUBLE ELSE 0.8::DOUBLE END AS device_fingerprint_match
  FROM txn LEFT JOIN k USING (user_id, device_id)"""))
def _(spark, d):
    rows = lean(spark, d)
    return j.known_device(rows, rows.where("status = 'CLEARED'")).select("transaction_id", "device_fingerprint_match")


@query("merchant_score_lookup", txn("""WITH s AS (SELECT merchant, avg(is_fraud::INTEGER) AS score FROM txn GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'BLOCKED' AND risk_score = 99) > 0)
  SELECT transaction_id, round(coalesce(score, 0.5), 8) AS merchant_risk_score FROM txn LEFT JOIN s USING (merchant)"""))
def _(spark, d):
    rows = lean(spark, d)
    scores = rows.groupBy("merchant").agg(
        F.avg(F.col("is_fraud").cast("int")).alias("score"),
        F.count_if((F.col("status") == "BLOCKED") & (F.col("risk_score") == 99)).alias("top"),
    ).where("top > 0")
    return j.merchant_score_lookup(rows, scores).select("transaction_id", F.round("merchant_risk_score", 8).alias("merchant_risk_score"))


@query("merchant_risk_asof", txn(f"""WITH {MERCHANT_SQL} SELECT merchant, strftime(day, '%Y-%m-%d') AS day, round(score, 8) AS score FROM mr"""))
def _(spark, d):
    rates = j.merchant_daily_rates(j.merchant_daily_counts(lean(spark, d)))
    return rates.select("merchant", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("score", 8).alias("score"))


@query("hourly_rate_aligned", txn("""WITH t AS (SELECT hour(ts) AS hour, count(*) AS n FROM txn GROUP BY 1), f AS (SELECT hour(ts) AS hour, count(*) AS n FROM txn WHERE is_fraud GROUP BY 1)
  SELECT CAST(coalesce(t.hour, f.hour) AS INTEGER) AS hour, coalesce(f.n / t.n::DOUBLE, 0) AS fraud_rate FROM t FULL JOIN f ON t.hour = f.hour"""))
def _(spark, d):
    return j.hourly_rate_aligned(lean(spark, d))


GRID_SQL = """WITH g AS (SELECT r_name AS region, channel FROM region, (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'refund']) AS channel)),
  c AS (SELECT region, channel, count(*) AS total, count(*) FILTER (WHERE is_fraud) AS fraud FROM txn GROUP BY ALL)
  SELECT g.region, g.channel, coalesce(total, 0) AS total, coalesce(fraud, 0) AS fraud"""


@query("grid_complete", txn(f"{GRID_SQL} FROM g LEFT JOIN c USING (region, channel)"))
def _(spark, d):
    return j.grid_complete(transactions(spark, d), "region", "channel", GEO_REGIONS, [*EVENT_CHANNELS, "refund"])


@query("heatmap_cells", txn(f"""{GRID_SQL}, CAST(CASE WHEN total > 0 THEN round(fraud * 100.0::DOUBLE / total) ELSE 0 END AS INTEGER) AS pct
  FROM g LEFT JOIN c USING (region, channel)"""))
def _(spark, d):
    return j.heatmap_cells(transactions(spark, d), GEO_REGIONS, [*EVENT_CHANNELS, "refund"])


@query("user_stats_enrich", txn(f"""WITH u AS (SELECT user_id, count(*) AS user_txns, round({money_avg_sql('amount')}, 4) AS user_avg_amount,
  count(*) FILTER (WHERE is_fraud) AS user_frauds FROM txn GROUP BY 1)
  SELECT transaction_id, user_id, user_txns, user_avg_amount, user_frauds FROM txn LEFT JOIN u USING (user_id)"""))
def _(spark, d):
    rows = lean(spark, d)
    return j.with_user_stats(rows, j.user_stats(rows)).select("transaction_id", "user_id", "user_txns", "user_avg_amount", "user_frauds")
