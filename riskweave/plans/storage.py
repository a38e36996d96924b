"""Queries over the stores: alerts, metrics and cached predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.models.ensemble import fallback_score
from riskweave.operators import alerts
from riskweave.plans.registry import iso_sql, query, txn
from riskweave.session import shared_dir
from riskweave.sources import stores
from riskweave.sources.tables import transactions


def lean(spark, d):
    return transactions(spark, d, region=False)


def with_now(rows, ts="ts"):
    """The newest time of the table as a column, standing in for the clock."""
    return rows.crossJoin(F.broadcast(rows.agg(F.max(ts).alias("now"))))


@query("alerts_dedup", txn("""WITH r AS (SELECT transaction_id, risk_score, 'fraud_and_gt80' AS rule FROM txn WHERE is_fraud AND risk_score > 80
    UNION ALL SELECT transaction_id, risk_score, 'ge80' FROM txn WHERE risk_score >= 80
    UNION ALL SELECT transaction_id, risk_score, 'fraud_or_gt72' FROM txn WHERE is_fraud OR risk_score > 72)
  SELECT transaction_id, min(rule) AS rule, any_value(risk_score) AS risk_score FROM r GROUP BY transaction_id"""))
def _(spark, d):
    fired = alerts.fired_rules(lean(spark, d)).select("transaction_id", "rule", "risk_score")
    return alerts.dedupe_alerts(fired)


@query("alerts_retention", txn(f"""WITH a AS (SELECT transaction_id, ts AS created_at FROM txn WHERE is_fraud AND risk_score > 80)
  SELECT transaction_id, {iso_sql('created_at')} AS created_at FROM a WHERE created_at > (SELECT max(created_at) FROM a) - INTERVAL 7 DAYS"""))
def _(spark, d):
    made = alerts.alert_candidates(lean(spark, d)).select("transaction_id", F.col("ts").alias("created_at"))
    kept = alerts.retained_alerts(with_now(made, "created_at"), F.col("now"))
    return kept.select("transaction_id", c.iso(F.col("created_at")).alias("created_at"))


@query("metric_snapshot", txn(f"""WITH m AS (SELECT 'metrics:latency:' || user_id AS name, CAST(processing_ms AS DOUBLE) AS value, ts AS updated_at FROM txn)
  SELECT name, arg_max(value, updated_at) AS value, {iso_sql('max(updated_at)')} AS updated_at FROM m GROUP BY name
  HAVING max(updated_at) + INTERVAL 36000 SECOND > (SELECT max(updated_at) FROM m)"""))
def _(spark, d):
    metrics = lean(spark, d).select(
        F.concat(F.lit("metrics:latency:"), F.col("user_id").cast("string")).alias("name"),
        F.col("processing_ms").cast("double").alias("value"), F.col("ts").alias("updated_at"))
    now = metrics.agg(F.max("updated_at").alias("now"))
    return stores.metric_snapshot(metrics, now, 36_000).withColumn("updated_at", c.iso(F.col("updated_at")))


@query("counter_totals", txn("""SELECT 'etl:total_count' AS name, count(*) AS value FROM txn UNION ALL
  SELECT 'etl:fraud_count', count(*) FROM txn WHERE is_fraud"""))
def _(spark, d):
    pair = F.array(
        F.struct(F.lit("etl:total_count").alias("name"), F.lit(1).cast("long").alias("value")),
        F.struct(F.lit("etl:fraud_count").alias("name"), F.col("is_fraud").cast("long").alias("value")))
    return stores.counter_totals(lean(spark, d).select(F.explode(pair).alias("_i")).select("_i.*"))


@query("latest_prediction", txn(f"""WITH p AS (SELECT transaction_id // 2 AS transaction_id, ts AS scored_at, least(1.0::DOUBLE, amount / 1000.0) AS fraud_probability FROM txn)
  SELECT transaction_id, {iso_sql('max(scored_at)')} AS scored_at, arg_max(fraud_probability, scored_at) AS fraud_probability FROM p GROUP BY transaction_id
  HAVING max(scored_at) + INTERVAL 86400 SECOND > (SELECT max(scored_at) FROM p)"""))
def _(spark, d):
    scored = fallback_score(lean(spark, d)).select(
        F.floor(F.col("transaction_id") / 2).alias("transaction_id"), F.col("ts").alias("scored_at"), "fraud_probability")
    now = scored.agg(F.max("scored_at").alias("now"))
    return stores.latest_prediction(scored, now, 86_400).withColumn("scored_at", c.iso(F.col("scored_at")))


@query("backfill_days", txn("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS rows, count(*) FILTER (WHERE is_fraud) AS fraud FROM txn GROUP BY 1"""))
def _(spark, d):
    """A table by day whose second half is derived anew; both halves must hold every row once."""
    path = f"{shared_dir(spark)}/backfill-{uuid.uuid4().hex}"
    rows = lean(spark, d)
    days = rows.agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")).first()
    middle = days["first"] + (days["last"] - days["first"]) // 2
    stores.backfill(rows, path, days["first"], days["last"])
    stores.backfill(rows, path, middle, days["last"])
    return spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("rows"), F.count_if("is_fraud").alias("fraud"))


@query("alerts_expired", txn(f"""WITH a AS (SELECT transaction_id, ts AS created_at FROM txn WHERE is_fraud AND risk_score > 80)
  SELECT transaction_id, {iso_sql('created_at')} AS created_at FROM a WHERE CAST(created_at AS DATE) >= (SELECT CAST(max(created_at) - INTERVAL 7 DAYS AS DATE) FROM a)"""))
def _(spark, d):
    """What the alert store still holds when its days past the retention are deleted."""
    store = stores.AlertStore(spark, f"{shared_dir(spark)}/alerts-{uuid.uuid4().hex}")
    made = alerts.alert_candidates(lean(spark, d)).select("transaction_id", F.col("ts").alias("created"))
    store.append(made, F.col("created"))
    return store.read(spark.read.parquet(store.path).schema).select("transaction_id", c.iso(F.col("created_at")).alias("created_at"))
