"""Summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.operators import aggregates as a
from riskweave.plans.registry import iso_sql, money_avg_sql, money_sum_sql, pay, query, txn
from riskweave.plans.rows import CATEGORY_SQL
from riskweave.schemas import CHANNELS, EVENT_CHANNELS
from riskweave.sources.tables import payments, transactions

FRAUD = "count(*) FILTER (WHERE is_fraud)"
PAY_FRAUD = "count(*) FILTER (WHERE isFraud = 1)"
RATE = f"{FRAUD} * 100.0::DOUBLE / count(*)"


def lean(spark, d):
    return transactions(spark, d, region=False)


def with_label(rows):
    return rows.withColumn("is_fraud", F.col("isFraud") == 1)


@query("dataset_totals", pay(f"""SELECT count(*) AS total, {PAY_FRAUD} AS fraud, count(*) FILTER (WHERE isFlaggedFraud = 1) AS flagged,
  round({PAY_FRAUD} * 100.0::DOUBLE / greatest(count(*), 1), 4) AS fraud_rate_pct FROM pay"""))
def _(spark, d):
    return a.dataset_totals(payments(spark, d, balances=False))


@query("fraud_amount_stats", pay(f"""SELECT round({money_avg_sql('amount')}, 4) AS avg_fraud_amount, {money_sum_sql('amount')} AS total_fraud_amount,
  count(*) AS count FROM pay WHERE isFraud = 1"""))
def _(spark, d):
    return a.fraud_amount_stats(payments(spark, d, balances=False))


@query("fraud_types_top5", pay(f"""SELECT type, count(*) AS count, round({money_avg_sql('amount')}, 4) AS avg_amount FROM pay WHERE isFraud = 1
  GROUP BY type ORDER BY count DESC, type LIMIT 5"""))
def _(spark, d):
    return a.fraud_types_top(payments(spark, d, balances=False))


@query("top_users", pay(f"""SELECT nameOrig, count(*) AS txn_count, {money_sum_sql('amount')} AS total_amount, {PAY_FRAUD} AS fraud_count
  FROM pay GROUP BY nameOrig ORDER BY txn_count DESC, nameOrig LIMIT 10"""))
def _(spark, d):
    return a.top_users(payments(spark, d, balances=False))


@query("fraud_per_type", pay(f"SELECT type, count(*) AS total, {PAY_FRAUD} AS fraud FROM pay GROUP BY type"))
def _(spark, d):
    return a.fraud_per_type(payments(spark, d, balances=False))


def _rate_sql(dim, expr, flag):
    return f"""SELECT {expr} AS {dim}, count(*) AS total_txns, count(*) FILTER (WHERE {flag}) AS fraud_count,
  round(count(*) FILTER (WHERE {flag}) * 100.0::DOUBLE / count(*), 4) AS fraud_rate_pct FROM"""


@query("fraud_rate_by_type", pay(_rate_sql("type", "type", "isFraud = 1") + " pay GROUP BY 1"))
def _(spark, d):
    return a.fraud_rate_by(payments(spark, d, balances=False), "type", "isFraud")


@query("fraud_rate_by_channel", txn(_rate_sql("channel", "channel", "is_fraud") + " txn GROUP BY 1"))
def _(spark, d):
    return a.fraud_rate_by(lean(spark, d), "channel")


@query("fraud_rate_by_amount_category", txn(_rate_sql("amount_category", CATEGORY_SQL, "is_fraud") + " txn GROUP BY 1"))
def _(spark, d):
    rows = lean(spark, d).withColumn("amount_category", c.amount_category(F.col("amount")))
    return a.fraud_rate_by(rows, "amount_category")


@query("fraud_share_total", pay(f"""SELECT {money_sum_sql('CASE WHEN isFraud = 1 THEN amount END')} AS fraud_amount,
  round({PAY_FRAUD} * 100.0::DOUBLE / count(*), 4) AS fraud_pct FROM pay"""))
def _(spark, d):
    return a.fraud_share_total(payments(spark, d, balances=False))


@query("stats_by_label", pay(f"""SELECT isFraud = 1 AS is_fraud, count(*) AS count, round({money_avg_sql('amount')}, 2) AS avg_amount,
  round({money_avg_sql('oldbalanceOrg')}, 2) AS avg_old_balance, round({money_avg_sql('newbalanceOrig')}, 2) AS avg_new_balance,
  round({money_avg_sql('oldbalanceDest')}, 2) AS avg_dest_old_balance FROM pay GROUP BY 1"""))
def _(spark, d):
    return a.stats_by_label(payments(spark, d))


@query("overall_stats", txn(f"""SELECT count(*) AS total_txns, {FRAUD} AS fraud_count, round({RATE}, 4) AS fraud_rate_pct,
  round({money_avg_sql('amount')}, 2) AS avg_amount, round(stddev_samp(amount), 2) AS std_amount,
  round(min(amount), 2) AS min_amount, round(max(amount), 2) AS max_amount FROM txn"""))
def _(spark, d):
    return a.overall_stats(lean(spark, d))


@query("fraud_by_region_type", txn("SELECT region, fraud_type, count(*) AS count FROM txn WHERE is_fraud GROUP BY ALL"))
def _(spark, d):
    return a.fraud_by_region_type(transactions(spark, d))


@query("rate_by_region", txn(f"SELECT region, {RATE} AS fraud_rate_pct FROM txn GROUP BY region"))
def _(spark, d):
    return a.rate_by(transactions(spark, d), "region")


@query("rate_by_channel", txn(f"SELECT channel, {RATE} AS fraud_rate_pct FROM txn GROUP BY channel"))
def _(spark, d):
    return a.rate_by(lean(spark, d), "channel")


@query("rate_by_type", pay(f"SELECT type, {PAY_FRAUD} * 100.0::DOUBLE / count(*) AS fraud_rate_pct FROM pay GROUP BY type"))
def _(spark, d):
    return a.rate_by(payments(spark, d, balances=False), "type", "isFraud")


@query("hourly_stats", txn(f"SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS total, {FRAUD} AS fraud, {RATE} AS fraud_rate_pct FROM txn GROUP BY 1"))
def _(spark, d):
    return a.hourly_stats(lean(spark, d))


def _pivot_sql(row, column, values, flag, view):
    cells = ", ".join(
        f"""count(*) FILTER (WHERE {column} = '{v}' AND {flag}) * 100.0::DOUBLE / nullif(count(*) FILTER (WHERE {column} = '{v}'), 0) AS "{v}\""""
        for v in values)
    return f"SELECT {row}, {cells} FROM {view} GROUP BY {row}"


@query("rate_pivot", txn(_pivot_sql("region", "channel", EVENT_CHANNELS, "is_fraud", "txn")))
def _(spark, d):
    return a.rate_pivot(transactions(spark, d), "region", "channel", EVENT_CHANNELS)


@query("rate_pivot_type_channel", pay("""WITH ch AS (SELECT isFraud, type, CASE type WHEN 'PAYMENT' THEN 'WEB' WHEN 'TRANSFER' THEN 'API' WHEN 'CASH_OUT' THEN 'ATM'
  WHEN 'CASH_IN' THEN 'MOBILE' WHEN 'DEBIT' THEN 'POS' END AS channel FROM pay) """ + _pivot_sql("type", "channel", CHANNELS, "isFraud = 1", "ch")))
def _(spark, d):
    rows = payments(spark, d, balances=False).withColumn("channel", c.type_channel(F.col("type")))
    return a.rate_pivot(rows, "type", "channel", CHANNELS, "isFraud")


@query("merchant_ranking", txn(f"""SELECT merchant, count(*) AS txns, {FRAUD} AS fraud, round(avg(risk_score), 4) AS avg_risk,
  round({money_avg_sql('amount')}, 4) AS avg_amount, {RATE} AS fraud_rate_pct FROM txn GROUP BY merchant"""))
def _(spark, d):
    return a.merchant_ranking(lean(spark, d))


def _value_counts(dim):
    @query(f"value_counts_{dim}", txn(f"SELECT {dim}, count(*) AS count FROM txn WHERE {dim} IS NOT NULL GROUP BY {dim}"))
    def _(spark, d):
        return a.value_counts(transactions(spark, d, region=dim == "region"), dim)


for _dim in ("fraud_type", "channel", "region"):
    _value_counts(_dim)


@query("type_share", txn("""SELECT fraud_type, count(*) AS count, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM txn WHERE is_fraud) AS share_pct
  FROM txn WHERE is_fraud GROUP BY fraud_type"""))
def _(spark, d):
    return a.type_share(lean(spark, d))


DESCRIBED = ["amount", "risk_score", "processing_ms", "latitude"]


@query("describe_numeric", txn("WITH " + ", ".join(["u AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS metric, CAST({n} AS DOUBLE) AS x FROM txn" for n in DESCRIBED) + ")"]) + """
  SELECT metric, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25,
  round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max FROM u GROUP BY metric"""))
def _(spark, d):
    out = a.describe_numeric(lean(spark, d), DESCRIBED)
    digits = {"mean": 4, "std": 4, "p25": 6, "p50": 6, "p75": 6}
    return out.withColumns({n: F.round(n, k) for n, k in digits.items()})


def _histogram_sql(bins, by=""):
    return f"""WITH lim AS (SELECT min(x) AS lo, max(x) AS hi FROM h)
  SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin{by}, count(*) AS count FROM h, lim GROUP BY ALL"""


@query("histogram_amount", txn(_histogram_sql(50).replace("WITH lim", "WITH h AS (SELECT amount AS x FROM txn), lim")))
def _(spark, d):
    return a.histogram(lean(spark, d), "amount", 50)


@query("histogram_risk_by_class", txn(_histogram_sql(40, ", is_fraud").replace(
    "WITH lim", "WITH h AS (SELECT CAST(risk_score AS DOUBLE) AS x, is_fraud FROM txn), lim")))
def _(spark, d):
    rows = lean(spark, d).withColumn("risk_score", F.col("risk_score").cast("double"))
    return a.histogram(rows, "risk_score", 40, "is_fraud")


@query("histogram_latency", txn(_histogram_sql(30).replace("WITH lim", "WITH h AS (SELECT CAST(processing_ms AS DOUBLE) AS x FROM txn), lim")))
def _(spark, d):
    rows = lean(spark, d).withColumn("processing_ms", F.col("processing_ms").cast("double"))
    return a.histogram(rows, "processing_ms", 30)


CORRELATED = ["amount", "risk_score", "processing_ms", "latitude"]


@query("correlation_matrix", txn(" UNION ALL ".join(
    f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 6) AS r FROM txn"
    for i, x in enumerate(CORRELATED) for y in CORRELATED[i + 1:])))
def _(spark, d):
    return a.correlation_matrix(lean(spark, d), CORRELATED).withColumn("r", F.round("r", 6))


@query("kpi_summary", txn(f"""SELECT count(*) AS total, {FRAUD} AS fraud, {RATE} AS fraud_rate_pct, round(avg(risk_score), 4) AS avg_risk,
  round({money_avg_sql('amount')}, 4) AS avg_amount FROM txn"""))
def _(spark, d):
    return a.kpi_summary(lean(spark, d))


@query("volume_share", txn(f"""WITH v AS (SELECT {money_sum_sql('amount')} AS total_volume,
  coalesce({money_sum_sql('CASE WHEN is_fraud THEN amount END')}, 0) AS fraud_volume FROM txn)
  SELECT *, round(fraud_volume * 100 / total_volume, 4) AS share_pct FROM v"""))
def _(spark, d):
    return a.volume_share(lean(spark, d))


@query("alerts_by_type", txn("""SELECT coalesce(fraud_type, 'Unknown') AS fraud_type, count(*) AS count FROM txn WHERE risk_score > 72 OR risk_score < 5
  GROUP BY 1"""))
def _(spark, d):
    return a.alerts_by_type(lean(spark, d).where("risk_score > 72 OR risk_score < 5"))


@query("dashboard_metrics", txn(f"""WITH t AS (SELECT string_agg(k || '=' || n, ',' ORDER BY k) AS by_type FROM (SELECT fraud_type AS k, count(*) AS n FROM txn WHERE is_fraud GROUP BY 1)),
  r AS (SELECT string_agg(k || '=' || n, ',' ORDER BY k) AS by_region FROM (SELECT region AS k, count(*) AS n FROM txn WHERE is_fraud GROUP BY 1))
  SELECT count(*) AS total_transactions, {FRAUD} AS total_fraud, round({RATE}, 2) AS fraud_rate, avg(risk_score) AS avg_risk_score,
  any_value(by_type) AS by_type, any_value(by_region) AS by_region FROM txn, t, r"""))
def _(spark, d):
    def text(name):
        return F.array_join(F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")

    out = a.dashboard_metrics(transactions(spark, d))
    return out.select("total_transactions", "total_fraud", "fraud_rate", "avg_risk_score",
                      text("fraud_by_type").alias("by_type"), text("fraud_by_region").alias("by_region"))


@query("etl_batch_stats", txn(f"""SELECT transaction_id // 100 AS batch, count(*) AS total, {FRAUD} AS fraud,
  CAST(sum(risk_score) AS DOUBLE) / count(risk_score) AS avg_risk FROM txn GROUP BY 1"""))
def _(spark, d):
    return a.etl_batch_stats(lean(spark, d)).select("batch", "total", "fraud", "avg_risk")


@query("fraud_burst", txn(f"""SELECT {iso_sql("time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2024-01-01')")} AS window_start, count(*) AS frauds FROM txn WHERE is_fraud
  GROUP BY 1 HAVING count(*) >= 10"""))
def _(spark, d):
    return a.fraud_burst(lean(spark, d), "3 hours").select(c.iso(F.col("window.start")).alias("window_start"), "frauds")


@query("latency_alert", txn(f"""SELECT {iso_sql("time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01')")} AS window_start, avg(processing_ms) AS avg_ms FROM txn
  GROUP BY 1 HAVING avg(processing_ms) > 80"""))
def _(spark, d):
    return a.latency_alert(lean(spark, d), "15 minutes", 80).select(c.iso(F.col("window.start")).alias("window_start"), "avg_ms")


@query("distinct_values", pay("SELECT DISTINCT type FROM pay"))
def _(spark, d):
    return payments(spark, d, balances=False).select("type").distinct()


@query("top_category", txn(f"SELECT channel, {RATE} AS fraud_rate_pct FROM txn GROUP BY channel ORDER BY 2 DESC, 1 LIMIT 1"))
def _(spark, d):
    return a.top_category(lean(spark, d), "channel")


@query("entity_edges", txn("SELECT user_id, merchant, count(*) AS links, max(risk_score) AS max_risk FROM txn WHERE is_fraud GROUP BY ALL"))
def _(spark, d):
    return a.entity_edges(lean(spark, d))


@query("entity_degree", txn("""SELECT 'user' AS kind, CAST(user_id AS VARCHAR) AS node, count(*) AS degree FROM txn WHERE is_fraud GROUP BY ALL
  UNION ALL SELECT 'merchant', merchant, count(*) FROM txn WHERE is_fraud GROUP BY ALL"""))
def _(spark, d):
    return a.entity_degree(lean(spark, d))


@query("latency_percentiles", txn("""SELECT CAST(hour(ts) AS INTEGER) AS hour, avg(processing_ms) AS avg_ms, round(quantile_cont(processing_ms, 0.5), 6) AS p50_ms,
  round(quantile_cont(processing_ms, 0.99), 6) AS p99_ms FROM txn GROUP BY 1"""))
def _(spark, d):
    out = a.latency_percentiles(lean(spark, d))
    return out.withColumns({n: F.round(n, 6) for n in ("p50_ms", "p99_ms")})


@query("risk_rank", txn(f"SELECT merchant, {RATE} AS fraud_rate_pct, CAST(rank() OVER (ORDER BY {RATE} DESC) AS INTEGER) AS rank FROM txn GROUP BY merchant"))
def _(spark, d):
    return a.risk_rank(lean(spark, d))
