"""Windowed aggregates in their batch form, and trailing metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.operators import alerts, running as r
from riskweave.plans.registry import iso_sql, money_avg_sql, money_sum_sql, query, txn
from riskweave.sources.tables import transactions
from riskweave.streaming import aggregates as w


def lean(spark, d):
    return transactions(spark, d, region=False)


def flat(df, *columns):
    """Window start and end as text, then the given columns."""
    return df.select(
        c.iso(F.col("window.start")).alias("window_start"), c.iso(F.col("window.end")).alias("window_end"), *columns)


def _window_sql(seconds, slide, source="txn"):
    """Rows repeated for every window that contains them."""
    return f"""win AS (SELECT t.*, time_bucket(INTERVAL {slide} SECOND, ts, TIMESTAMP '2024-01-01') - to_seconds(k * {slide}) AS ws
    FROM {source} t, range({seconds // slide}) o(k))"""


def _bounds(seconds):
    return f"{iso_sql('ws')} AS window_start, {iso_sql(f'ws + INTERVAL {seconds} SECOND')} AS window_end"


SLIDING_SQL = txn(f"""WITH {_window_sql(30, 15)} SELECT {_bounds(30)}, region, channel, count(*) AS total_transactions,
  {money_sum_sql('amount')} AS total_amount, round({money_avg_sql('amount')}, 4) AS avg_amount, count(*) FILTER (WHERE is_fraud) AS fraud_count,
  round({money_sum_sql('CASE WHEN is_fraud THEN amount ELSE 0 END')} / count(*), 4) AS avg_fraud_amount, round(avg(risk_score), 4) AS avg_risk_score
  FROM win GROUP BY ws, region, channel""")
TUMBLING_SQL = txn(f"""WITH {_window_sql(300, 300)} SELECT {_bounds(300)}, region, fraud_type, count(*) AS fraud_count,
  round({money_avg_sql('amount')}, 4) AS avg_fraud_amount, round(avg(risk_score), 4) AS avg_risk_score
  FROM win WHERE is_fraud GROUP BY ws, region, fraud_type""")
METRICS_SQL = txn(f"""WITH {_window_sql(60, 60)} SELECT {_bounds(60)}, count(*) AS txn_count, count(*) FILTER (WHERE is_fraud) AS fraud_count,
  round(avg(risk_score), 4) AS avg_risk, round({money_avg_sql('amount')}, 4) AS avg_amount, round(avg(processing_ms), 4) AS avg_latency_ms
  FROM win GROUP BY ws""")
LABEL_SQL = txn(f"""WITH {_window_sql(30, 10)} SELECT {_bounds(30)}, channel, is_fraud, count(*) AS count FROM win GROUP BY ws, channel, is_fraud""")
RUNNING_SQL = txn("SELECT region, fraud_type, count(*) AS count FROM txn WHERE is_fraud GROUP BY ALL")

SLIDING = ["region", "channel", "total_transactions", "total_amount", "avg_amount", "fraud_count", "avg_fraud_amount", "avg_risk_score"]
TUMBLING = ["region", "fraud_type", "fraud_count", "avg_fraud_amount", "avg_risk_score"]
METRICS = ["txn_count", "fraud_count", "avg_risk", "avg_amount", "avg_latency_ms"]


@query("sliding_region_channel", SLIDING_SQL)
def _(spark, d):
    return flat(w.sliding_region_channel(transactions(spark, d), watermark=None), *SLIDING)


@query("tumbling_fraud_5m", TUMBLING_SQL)
def _(spark, d):
    return flat(w.tumbling_fraud(transactions(spark, d), watermark=None), *TUMBLING)


@query("realtime_metrics_1m", METRICS_SQL)
def _(spark, d):
    return flat(w.realtime_metrics(lean(spark, d), watermark=None), *METRICS)


@query("sliding_type_label", LABEL_SQL)
def _(spark, d):
    return flat(w.sliding_type_label(lean(spark, d), watermark=None), "channel", "is_fraud", "count")


@query("running_fraud_counts", RUNNING_SQL)
def _(spark, d):
    return w.running_fraud_counts(transactions(spark, d))


@query("trailing_latency_100", txn("""SELECT transaction_id, round(avg(processing_ms) OVER (ORDER BY ts, transaction_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS avg_latency_ms FROM txn"""))
def _(spark, d):
    return r.trailing_latency(lean(spark, d)).select("transaction_id", F.round("avg_latency_ms", 6).alias("avg_latency_ms"))


@query("trailing_latency_100_by_channel", txn("""SELECT transaction_id, round(avg(processing_ms) OVER (PARTITION BY channel ORDER BY ts, transaction_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS avg_latency_ms FROM txn"""))
def _(spark, d):
    return r.trailing_latency(lean(spark, d), key=["channel"]).select("transaction_id", F.round("avg_latency_ms", 6).alias("avg_latency_ms"))


@query("throughput_60s", txn("""SELECT transaction_id, least(60, count(*) OVER (ORDER BY epoch_us(ts) RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW)) AS throughput FROM txn"""))
def _(spark, d):
    return r.throughput(lean(spark, d)).select("transaction_id", F.col("throughput").cast("long").alias("throughput"))


def _recent(name, key, n, condition):
    @query(name, txn(f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, transaction_id DESC) AS rank FROM txn WHERE {condition})
  SELECT {key}, CAST(rank AS INTEGER) AS rank, transaction_id, risk_score FROM k WHERE rank <= {n}"""))
    def _(spark, d):
        rows = r.recent_per_key(lean(spark, d).where(condition), [key], n)
        return rows.select(key, "rank", "transaction_id", "risk_score")


_recent("recent_per_user", "user_id", 8, "is_fraud AND risk_score > 80")
_recent("recent_alerts_per_merchant", "merchant", 100, "is_fraud AND risk_score > 80")


@query("acknowledge_alert", txn(f"""SELECT substr(sha256(CAST(transaction_id AS VARCHAR) || {iso_sql('ts')}), 1, 8) AS alert_id, transaction_id,
  coalesce(status = 'CONFIRMED', false) AS acknowledged FROM txn WHERE is_fraud AND risk_score > 80"""))
def _(spark, d):
    chosen = alerts.alert_candidates(lean(spark, d)).withColumn("region", F.lit(None).cast("string"))
    made = alerts.alert_payload(chosen)
    confirmed = chosen.where("status = 'CONFIRMED'").select("transaction_id")
    return alerts.acknowledge(made, confirmed).select("alert_id", "transaction_id", "acknowledged")


@query("running_counters", txn("""WITH b AS (SELECT transaction_id // 100 AS batch, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS f, sum(risk_score) AS r FROM txn GROUP BY 1)
  SELECT batch, CAST(sum(n) OVER w AS BIGINT) AS total_count, CAST(sum(f) OVER w AS BIGINT) AS fraud_count, CAST(r AS DOUBLE) / n AS batch_avg_risk,
  CAST(sum(r) OVER w AS DOUBLE) / sum(n) OVER w AS running_avg_risk FROM b WINDOW w AS (ORDER BY batch)"""))
def _(spark, d):
    return r.running_counters(lean(spark, d))
