"""Row-wise queries: parsing, enrichment, classification, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions import columns as c
from riskweave.operators import alerts, projections as p
from riskweave.plans.registry import iso_sql, pay, query, txn
from riskweave.schemas import GEO_CROSS_BORDER, TRANSACTION
from riskweave.session import materialize
from riskweave.sources.tables import payments, transactions

CATEGORY_SQL = "CASE WHEN amount > 1000 THEN 'HIGH' WHEN amount > 300 THEN 'MEDIUM' ELSE 'LOW' END"
LEVEL_SQL = "CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END"
RISK_CATEGORY_SQL = """CASE WHEN risk_score > 0 AND risk_score <= 30 THEN 'LOW' WHEN risk_score > 30 AND risk_score <= 60 THEN 'MEDIUM'
  WHEN risk_score > 60 AND risk_score <= 80 THEN 'HIGH' WHEN risk_score > 80 AND risk_score <= 100 THEN 'CRITICAL' END"""
CROSS_SQL = "region IN ('AMERICA', 'ASIA', 'MIDDLE EAST')"
ENRICH_SQL = f"""{CATEGORY_SQL} AS amount_category, amount > 500 AS is_high_amount,
  {CROSS_SQL} AS is_cross_border, {LEVEL_SQL} AS risk_level"""


def json_messages(rows):
    """Transactions as the JSON messages a topic would carry."""
    fields = [
        F.col("transaction_id").cast("string").alias("transaction_id"),
        c.iso(F.col("ts")).alias("timestamp"),
        *[F.col(n) for n in ("amount", "merchant", "region", "channel", "fraud_type", "risk_score", "status")],
        F.col("user_id").cast("string").alias("user_id"),
        *[F.col(n) for n in ("is_fraud", "latitude", "longitude")],
        F.col("device_id").cast("string").alias("device_id"),
        F.lit(None).cast("string").alias("ip_address"),
        F.col("processing_ms"),
    ]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


@query("parse_transactions", txn("""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, amount, merchant, region, channel,
  fraud_type, risk_score, status, CAST(user_id AS VARCHAR) AS user_id, is_fraud FROM txn"""))
def _(spark, d):
    parsed = p.parse_transactions(json_messages(transactions(spark, d)), TRANSACTION)
    return parsed.select("transaction_id", "amount", "merchant", "region", "channel", "fraud_type",
                         "risk_score", "status", "user_id", "is_fraud")


@query("event_time", f"SELECT event_id, {iso_sql('ts')} AS event_time FROM events")
def _(spark, d):
    text = transactions(spark, d, region=False).select(
        "transaction_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    return p.with_event_time(text).select(
        F.col("transaction_id").alias("event_id"), c.iso(F.col("event_time")).alias("event_time"))


@query("amount_category", txn(f"SELECT transaction_id, {CATEGORY_SQL} AS amount_category FROM txn"))
def _(spark, d):
    return transactions(spark, d, region=False).select(
        "transaction_id", c.amount_category(F.col("amount")).alias("amount_category"))


@query("is_high_amount", txn("SELECT transaction_id, amount > 500 AS is_high_amount FROM txn"))
def _(spark, d):
    return transactions(spark, d, region=False).select(
        "transaction_id", c.is_high_amount(F.col("amount")).alias("is_high_amount"))


@query("is_cross_border", txn(f"SELECT transaction_id, region, {CROSS_SQL} AS is_cross_border FROM txn"))
def _(spark, d):
    return transactions(spark, d).select(
        "transaction_id", "region", c.is_cross_border(F.col("region"), GEO_CROSS_BORDER).alias("is_cross_border"))


@query("risk_level", txn(f"SELECT transaction_id, risk_score, {LEVEL_SQL} AS risk_level FROM txn"))
def _(spark, d):
    return transactions(spark, d, region=False).select(
        "transaction_id", "risk_score", c.risk_level(F.col("risk_score")).alias("risk_level"))


@query("risk_category", txn(f"SELECT transaction_id, risk_score, {RISK_CATEGORY_SQL} AS risk_category FROM txn"))
def _(spark, d):
    return transactions(spark, d, region=False).select(
        "transaction_id", "risk_score", c.risk_category(F.col("risk_score")).alias("risk_category"))


@query("amount_bucket", txn("""SELECT transaction_id, CASE WHEN amount > 1000 THEN 'HIGH' WHEN amount > 300 THEN 'MEDIUM'
  WHEN amount > 0 THEN 'LOW' END AS amount_bucket FROM txn"""))
def _(spark, d):
    return transactions(spark, d, region=False).select(
        "transaction_id", c.amount_bucket(F.col("amount")).alias("amount_bucket"))


@query("time_parts", txn("""SELECT transaction_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend FROM txn"""))
def _(spark, d):
    ts = F.col("ts")
    return transactions(spark, d, region=False).select(
        "transaction_id", c.hour_of_day(ts).alias("hour"), c.day_of_week(ts).alias("day_of_week"),
        c.is_weekend(ts).alias("is_weekend"))


@query("amount_log", txn("SELECT transaction_id, round(ln(1 + amount), 6) AS amount_log FROM txn"))
def _(spark, d):
    return transactions(spark, d, region=False).select(
        "transaction_id", F.round(F.log1p("amount"), 6).alias("amount_log"))


@query("step_to_time", pay(f"""SELECT step, {iso_sql("TIMESTAMP '2024-01-01' + to_hours(step)")} AS event_time, count(*) AS rows
  FROM pay GROUP BY ALL"""))
def _(spark, d):
    return (payments(spark, d, balances=False)
            .select("step", c.iso(c.step_time(F.col("step"))).alias("event_time"))
            .groupBy("step", "event_time").agg(F.count("*").alias("rows")))


@query("type_to_channel", pay("""SELECT type, CASE type WHEN 'PAYMENT' THEN 'WEB' WHEN 'TRANSFER' THEN 'API' WHEN 'CASH_OUT' THEN 'ATM'
  WHEN 'CASH_IN' THEN 'MOBILE' WHEN 'DEBIT' THEN 'POS' END AS channel, nameOrig, amount FROM pay"""))
def _(spark, d):
    return payments(spark, d, balances=False).select(
        "type", c.type_channel(F.col("type")).alias("channel"), "nameOrig", "amount")


@query("transaction_id_format", """SELECT event_id, 'TXN-' || CASE WHEN length(event_id::VARCHAR) < 7 THEN lpad(event_id::VARCHAR, 7, '0') ELSE event_id::VARCHAR END AS transaction_id,
  'USR-' || CASE WHEN length(user_id::VARCHAR) < 4 THEN lpad(user_id::VARCHAR, 4, '0') ELSE user_id::VARCHAR END AS user_id FROM events""")
def _(spark, d):
    rows = transactions(spark, d, region=False)
    return rows.select(
        F.col("transaction_id").alias("event_id"),
        c.padded_id("TXN-", F.col("transaction_id"), 7).alias("transaction_id"),
        c.padded_id("USR-", F.col("user_id"), 4).alias("user_id"))


@query("high_risk_type", pay("SELECT nameOrig, type, amount, type IN ('TRANSFER', 'CASH_OUT') AS is_high_risk_type FROM pay"))
def _(spark, d):
    return payments(spark, d, balances=False).select(
        "nameOrig", "type", "amount", c.high_risk_type(F.col("type")).alias("is_high_risk_type"))


@query("balance_discrepancy", pay("""SELECT nameOrig, nameDest, amount, abs(oldbalanceOrg - newbalanceOrig - amount) > 1 AS balance_discrepancy FROM pay"""))
def _(spark, d):
    return payments(spark, d).select("nameOrig", "nameDest", "amount", c.balance_discrepancy(
        F.col("oldbalanceOrg"), F.col("newbalanceOrig"), F.col("amount")).alias("balance_discrepancy"))


@query("balance_features", pay("""SELECT nameOrig, nameDest, amount, oldbalanceOrg - newbalanceOrig AS balance_change_orig,
  oldbalanceDest - newbalanceDest AS balance_change_dest, CAST(oldbalanceDest = 0 AS INTEGER) AS is_dest_new,
  round(amount / (oldbalanceOrg + 1), 8) AS amount_to_balance_ratio FROM pay"""))
def _(spark, d):
    return p.balance_features(payments(spark, d)).select(
        "nameOrig", "nameDest", "amount", "balance_change_orig", "balance_change_dest", "is_dest_new",
        F.round("amount_to_balance_ratio", 8).alias("amount_to_balance_ratio"))


@query("enrich_payments", pay(f"""SELECT nameOrig, nameDest, amount, {CATEGORY_SQL} AS amount_category, amount > 500 AS is_high_amount,
  type IN ('TRANSFER', 'CASH_OUT') AS is_high_risk_type,
  abs(oldbalanceOrg - newbalanceOrig - amount) > 1 AS balance_discrepancy FROM pay"""))
def _(spark, d):
    return p.enrich_payments(payments(spark, d)).select(
        "nameOrig", "nameDest", "amount", "amount_category", "is_high_amount", "is_high_risk_type", "balance_discrepancy")


@query("type_one_hot", pay("""SELECT nameOrig, nameDest, amount, CAST(type = 'PAYMENT' AS INTEGER) AS type_PAYMENT, CAST(type = 'TRANSFER' AS INTEGER) AS type_TRANSFER,
  CAST(type = 'CASH_OUT' AS INTEGER) AS type_CASH_OUT, CAST(type = 'CASH_IN' AS INTEGER) AS type_CASH_IN,
  CAST(type = 'DEBIT' AS INTEGER) AS type_DEBIT FROM pay"""))
def _(spark, d):
    return p.type_one_hot(payments(spark, d, balances=False)).select(
        "nameOrig", "nameDest", "amount", *[f"type_{t}" for t in ("PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT")])


@query("clean_numeric", pay("""SELECT nameOrig, nameDest, amount,
  CASE WHEN oldbalanceOrg = 0 THEN 0 ELSE round(amount / nullif(oldbalanceOrg, 0), 8) END AS raw_ratio FROM pay"""))
def _(spark, d):
    ratio = F.when(F.col("oldbalanceOrg") == 0, float("inf")).otherwise(
        F.round(F.try_divide("amount", "oldbalanceOrg"), 8))
    rows = payments(spark, d).withColumn("raw_ratio", ratio)
    return p.clean_numeric(rows, ["raw_ratio"]).select("nameOrig", "nameDest", "amount", "raw_ratio")


@query("high_amount_p95", pay("""WITH lim AS (SELECT quantile_cont(amount, 0.95) AS q FROM pay)
  SELECT nameOrig, nameDest, amount, CAST(amount > q AS INTEGER) AS is_high_amount FROM pay, lim"""))
def _(spark, d):
    # Written, so that percentile and result share one join.
    rows = materialize(payments(spark, d, balances=False).select("nameOrig", "nameDest", "amount"))
    return p.high_amount_p95(rows, written=True)


def _alert_query(name, rule, condition):
    @query(name, txn(f"SELECT transaction_id, user_id, risk_score, is_fraud FROM txn WHERE {condition}"))
    def _(spark, d):
        rows = transactions(spark, d, region=False)
        return alerts.alert_candidates(rows, rule).select("transaction_id", "user_id", "risk_score", "is_fraud")


_alert_query("alert_candidates_fraud_and_gt80", "fraud_and_gt80", "is_fraud AND risk_score > 80")
_alert_query("alert_candidates_ge80", "ge80", "risk_score >= 80")
_alert_query("alert_candidates_fraud_or_gt72", "fraud_or_gt72", "is_fraud OR risk_score > 72")


@query("alert_payload", txn(f"""SELECT substr(sha256(CAST(transaction_id AS VARCHAR) || {iso_sql('ts')}), 1, 8) AS alert_id, transaction_id,
  coalesce(fraud_type, 'unknown') AS fraud_type, risk_score, merchant, user_id, region, {iso_sql('ts')} AS timestamp,
  'HIGH RISK: ' || coalesce(fraud_type, 'None') || ' detected on ' || merchant AS message, false AS acknowledged
  FROM txn WHERE risk_score >= 80"""))
def _(spark, d):
    chosen = alerts.alert_candidates(transactions(spark, d), "ge80")
    return alerts.alert_payload(chosen).withColumn("timestamp", c.iso(F.col("timestamp")))


@query("alert_payload_predictor", txn("""SELECT transaction_id AS alert_id, transaction_id, user_id, coalesce(fraud_type, 'Suspicious') AS fraud_type,
  risk_score, merchant, 'HIGH RISK: risk_score=' || risk_score || ' for ' || user_id AS message
  FROM txn WHERE is_fraud OR risk_score > 72"""))
def _(spark, d):
    chosen = alerts.alert_candidates(transactions(spark, d, region=False), "fraud_or_gt72")
    return alerts.predictor_alert_payload(chosen).drop("timestamp")


@query("severity", txn("""SELECT transaction_id, CASE WHEN risk_score >= 95 THEN 'critical' WHEN risk_score >= 80 THEN 'high' END AS severity
  FROM txn WHERE risk_score >= 80"""))
def _(spark, d):
    return alerts.alert_candidates(transactions(spark, d, region=False), "ge80").select(
        "transaction_id", c.severity(F.col("risk_score")).alias("severity"))


@query("transaction_filter", txn(f"""SELECT transaction_id, {iso_sql('ts')} AS ts, status, risk_score, is_fraud FROM txn
  WHERE status = 'FLAGGED' AND risk_score >= 60 AND is_fraud ORDER BY txn.ts DESC, transaction_id DESC LIMIT 50"""))
def _(spark, d):
    rows = transactions(spark, d, region=False)
    return p.transaction_filter(rows, "FLAGGED", 60, True).select(
        "transaction_id", c.iso(F.col("ts")).alias("ts"), "status", "risk_score", "is_fraud")


@query("transaction_filter_off", txn(f"""SELECT transaction_id, {iso_sql('ts')} AS ts, status, risk_score, is_fraud FROM txn
  ORDER BY txn.ts DESC, transaction_id DESC LIMIT 500"""))
def _(spark, d):
    rows = transactions(spark, d, region=False)
    return p.transaction_filter(rows, None, 0, False, 500).select(
        "transaction_id", c.iso(F.col("ts")).alias("ts"), "status", "risk_score", "is_fraud")


@query("transaction_search", txn("""SELECT transaction_id, user_id, merchant, status, risk_score FROM txn
  WHERE status = 'REVIEWING' AND risk_score >= 72 AND (contains(upper(CAST(transaction_id AS VARCHAR)), 'T-5')
    OR contains(upper(merchant), 'T-5') OR contains(upper(CAST(user_id AS VARCHAR)), 'T-5'))"""))
def _(spark, d):
    rows = transactions(spark, d, region=False)
    return p.transaction_search(rows, "REVIEWING", "HIGH", "t-5").select(
        "transaction_id", "user_id", "merchant", "status", "risk_score")


@query("time_range", txn(f"""SELECT transaction_id, {iso_sql('ts')} AS ts, CAST(hour(txn.ts) AS INTEGER) AS hour, {RISK_CATEGORY_SQL} AS risk_category FROM txn
  WHERE txn.ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"""))
def _(spark, d):
    rows = p.time_range(transactions(spark, d, region=False), "2024-01-05 00:00:00", "2024-01-20 12:00:00")
    return p.etl_transform(rows).orderBy("ts").select(
        "transaction_id", c.iso(F.col("ts")).alias("ts"), "hour", "risk_category")


@query("fraud_only", txn("SELECT transaction_id, fraud_type, region FROM txn WHERE is_fraud"))
def _(spark, d):
    return transactions(spark, d).where("is_fraud").select("transaction_id", "fraud_type", "region")


@query("flagged_only", pay("SELECT nameOrig, nameDest, type, amount FROM pay WHERE isFlaggedFraud = 1"))
def _(spark, d):
    return payments(spark, d, balances=False).where("isFlaggedFraud = 1").select("nameOrig", "nameDest", "type", "amount")


@query("monitor_view", txn("SELECT transaction_id, user_id, amount, merchant, region, channel, risk_score, is_fraud FROM txn"))
def _(spark, d):
    return transactions(spark, d).select(p.MONITOR)


@query("rename_api", txn(f"""SELECT transaction_id AS id, {iso_sql('ts')} AS timestamp, amount, merchant, region, channel, fraud_type AS "fraudType",
  risk_score AS "riskScore", status, user_id AS "userId", is_fraud AS "isFraud" FROM txn"""))
def _(spark, d):
    rows = transactions(spark, d).select(
        "transaction_id", c.iso(F.col("ts")).alias("timestamp"), "amount", "merchant", "region", "channel",
        "fraud_type", "risk_score", "status", "user_id", "is_fraud")
    return p.rename_api(rows)


@query("enrich_transactions", txn(f"""SELECT transaction_id, user_id, amount, merchant, region, channel, fraud_type, risk_score, is_fraud,
  {ENRICH_SQL} FROM txn"""))
def _(spark, d):
    return p.enrich_transactions(transactions(spark, d), GEO_CROSS_BORDER).select(
        "transaction_id", "user_id", "amount", "merchant", "region", "channel", "fraud_type", "risk_score",
        "is_fraud", "amount_category", "is_high_amount", "is_cross_border", "risk_level")


@query("etl_transform", txn(f"""SELECT transaction_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend, round(ln(1 + amount), 6) AS amount_log, {RISK_CATEGORY_SQL} AS risk_category FROM txn"""))
def _(spark, d):
    return p.etl_transform(transactions(spark, d, region=False)).select(
        "transaction_id", "hour", "day_of_week", "is_weekend", F.round("amount_log", 6).alias("amount_log"), "risk_category")


@query("cold_start_features", txn(f"""SELECT transaction_id, amount AS transaction_amount, CAST(0 AS DOUBLE) AS velocity_1h, CAST(0.5 AS DOUBLE) AS merchant_risk_score,
  CAST(0 AS DOUBLE) AS geo_anomaly_score, CAST(0.8 AS DOUBLE) AS device_fingerprint_match, CAST(1 AS DOUBLE) AS time_since_last_txn,
  CAST(0 AS DOUBLE) AS amount_vs_avg_30d, CAST(0 AS DOUBLE) AS channel_frequency_score, CAST(hour(ts) AS DOUBLE) AS hour_of_day,
  CAST(isodow(ts) - 1 AS DOUBLE) AS day_of_week, CAST(amount > 500 AS DOUBLE) AS is_high_amount, CAST({CROSS_SQL} AS DOUBLE) AS is_cross_border FROM txn"""))
def _(spark, d):
    return p.cold_start_features(transactions(spark, d), cross_border=GEO_CROSS_BORDER)


@query("scalar_pack", txn(f"""SELECT transaction_id, 'USR-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_text, upper(merchant) AS merchant_upper,
  lower(channel) AS channel_lower, contains(upper(merchant), 'PAY') AS has_pay, regexp_matches(region, '^(ASIA|AMERICA)$') AS region_match,
  concat_ws(',', channel, region) AS joined, substr(sha256(CAST(transaction_id AS VARCHAR)), 1, 8) AS short_id,
  {iso_sql("ts + INTERVAL 5 HOUR")} AS later, CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 1000000 AS seconds,
  round(sqrt(latitude * latitude + longitude * longitude), 6) AS distance, abs(latitude) AS abs_latitude,
  least(1.0, amount / 1000.0) AS clamped, CAST(trunc(amount / 7) AS INTEGER) AS whole,
  coalesce(fraud_type, 'Unknown') AS fraud_label, fraud_type IS NOT NULL AS has_type FROM txn"""))
def _(spark, d):
    lat, lng, ts, amount = (F.col(n) for n in ("latitude", "longitude", "ts", "amount"))
    return transactions(spark, d).select(
        "transaction_id",
        c.padded_id("USR-", F.col("user_id"), 6).alias("user_text"),
        F.upper("merchant").alias("merchant_upper"),
        F.lower("channel").alias("channel_lower"),
        F.upper("merchant").contains("PAY").alias("has_pay"),
        F.col("region").rlike("^(ASIA|AMERICA)$").alias("region_match"),
        F.concat_ws(",", "channel", "region").alias("joined"),
        F.substring(F.sha2(F.col("transaction_id").cast("string"), 256), 1, 8).alias("short_id"),
        c.iso(F.timestamp_add("HOUR", F.lit(5), ts)).alias("later"),
        ((F.unix_micros(ts) - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))).cast("double") / c.MICROS).alias("seconds"),
        F.round(F.sqrt(lat * lat + lng * lng), 6).alias("distance"),
        F.abs(lat).alias("abs_latitude"),
        F.least(F.lit(1.0), amount / 1000.0).alias("clamped"),
        (amount / 7).cast("int").alias("whole"),
        F.coalesce("fraud_type", F.lit("Unknown")).alias("fraud_label"),
        F.col("fraud_type").isNotNull().alias("has_type"))


@query("json_roundtrip", """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, true AS same FROM events""")
def _(spark, d):
    rows = transactions(spark, d, region=False)
    packed = rows.select("transaction_id", "risk_score", F.struct("transaction_id", "amount", "channel", "is_fraud").alias("record"))
    back = F.from_json(F.to_json("record"), packed.schema["record"].dataType)
    return packed.select(
        F.col("transaction_id").alias("event_id"), F.col("risk_score").alias("k"), (back == F.col("record")).alias("same"))


@query("map_array_pack", txn("""SELECT transaction_id, round(risk_score / 100.0, 4) AS forest, round(least(1.0, amount / 1000.0), 4) AS boosted,
  CAST(2 AS INTEGER) AS models, concat_ws(',', CASE WHEN risk_score > 60 THEN 'AnomalyPattern' END,
  CASE WHEN amount > 500 THEN 'HighAmount' END) AS factors, coalesce(risk_score > 60, false) AS has_anomaly FROM txn"""))
def _(spark, d):
    scores = F.create_map(
        F.lit("isolation_forest"), F.round(F.col("risk_score") / 100.0, 4),
        F.lit("xgboost"), F.round(F.least(F.lit(1.0), F.col("amount") / 1000.0), 4))
    factors = F.array_compact(F.array(
        F.when(F.col("risk_score") > 60, "AnomalyPattern"), F.when(F.col("amount") > 500, "HighAmount")))
    packed = transactions(spark, d, region=False).select("transaction_id", scores.alias("scores"), factors.alias("factors"))
    return packed.select(
        "transaction_id", F.col("scores")["isolation_forest"].alias("forest"), F.element_at("scores", "xgboost").alias("boosted"),
        F.size("scores").alias("models"), F.concat_ws(",", "factors").alias("factors"),
        F.array_contains("factors", "AnomalyPattern").alias("has_anomaly"))
