"""Top-n, ordering and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.operators import aggregates, alerts, ranking as k
from riskweave.plans.registry import iso_sql, query, txn
from riskweave.sources.tables import transactions


def lean(spark, d):
    return transactions(spark, d, region=False)


@query("latest_transactions", txn(f"SELECT transaction_id, {iso_sql('ts')} AS time, user_id, amount FROM txn ORDER BY ts DESC, transaction_id DESC LIMIT 50"))
def _(spark, d):
    return k.latest_transactions(lean(spark, d)).select("transaction_id", c.iso(F.col("ts")).alias("time"), "user_id", "amount")


@query("latest_alerts", txn(f"""SELECT transaction_id, {iso_sql('ts')} AS time, coalesce(fraud_type, 'unknown') AS fraud_type, risk_score FROM txn
  WHERE is_fraud AND risk_score > 80 ORDER BY ts DESC, transaction_id DESC LIMIT 20"""))
def _(spark, d):
    made = alerts.alert_payload(alerts.alert_candidates(transactions(spark, d)))
    return k.latest_alerts(made).select("transaction_id", c.iso(F.col("timestamp")).alias("time"), "fraud_type", "risk_score")


@query("find_alerts", txn("""SELECT transaction_id, merchant, risk_score FROM txn
  WHERE is_fraud AND risk_score > 80 AND merchant = 'merchant-5' ORDER BY ts DESC, transaction_id DESC LIMIT 100"""))
def _(spark, d):
    made = alerts.alert_payload(alerts.alert_candidates(transactions(spark, d)))
    return k.latest_alerts(made, F.col("merchant") == "merchant-5", 100).select("transaction_id", "merchant", "risk_score")


@query("show_first", txn("SELECT transaction_id, user_id, amount FROM txn ORDER BY amount DESC, transaction_id LIMIT 20"))
def _(spark, d):
    return lean(spark, d).select("transaction_id", "user_id", "amount").orderBy(F.desc("amount"), "transaction_id").limit(20)


@query("sort_values", txn("""SELECT user_id, merchant, links, CAST(row_number() OVER (ORDER BY links DESC, user_id, merchant) AS INTEGER) AS place FROM
  (SELECT user_id, merchant, count(*) AS links FROM txn WHERE is_fraud GROUP BY ALL)"""))
def _(spark, d):
    edges = aggregates.entity_edges(lean(spark, d)).drop("max_risk")
    return k.placed(edges, -F.col("links"), ["user_id", "merchant"]).orderBy("place")


@query("head_rows", txn("SELECT transaction_id, user_id, amount FROM txn ORDER BY transaction_id LIMIT 5"))
def _(spark, d):
    return k.head_rows(lean(spark, d), 5).select("transaction_id", "user_id", "amount")


@query("tail_rows", txn("SELECT transaction_id, user_id, amount FROM txn ORDER BY transaction_id DESC LIMIT 5"))
def _(spark, d):
    return k.tail_rows(lean(spark, d), 5).select("transaction_id", "user_id", "amount")


@query("sample_rows", txn("""SELECT transaction_id, user_id, amount FROM txn
  ORDER BY ('0x' || substr(md5('42:' || transaction_id), 1, 8))::BIGINT, transaction_id LIMIT 500"""))
def _(spark, d):
    return k.sample_rows(lean(spark, d), 500).select("transaction_id", "user_id", "amount")
