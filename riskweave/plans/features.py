"""Behaviour-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import aggregates, features as f
from riskweave.plans.registry import money_sql, query, txn
from riskweave.schemas import FEATURES, GEO_CROSS_BORDER
from riskweave.sources.tables import transactions, user_regions


def lean(spark, d):
    return transactions(spark, d, region=False)


def _range(us, per="user_id"):
    return f"OVER (PARTITION BY {per} ORDER BY epoch_us(ts) RANGE BETWEEN {us} PRECEDING AND 1 PRECEDING)"


HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000
BACK_30 = _range(30 * DAY_US)
BACK_30_CHANNEL = _range(30 * DAY_US, "user_id, channel")
ROWS_BEFORE = "OVER (PARTITION BY user_id ORDER BY ts, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
ORDERED = "OVER (PARTITION BY user_id ORDER BY ts, transaction_id)"

GAP_SQL = f"coalesce(least(1.0::DOUBLE, (epoch_us(ts) - epoch_us(lag(ts) {ORDERED})) / 1000000 / 86400), 1.0::DOUBLE)"
MEAN_SQL = f"CAST(sum({money_sql('amount')}) {BACK_30} AS DOUBLE) / nullif(count({money_sql('amount')}) {BACK_30}, 0)"
DEVICE_SQL = "CASE WHEN row_number() OVER (PARTITION BY user_id, device_id ORDER BY ts, transaction_id) = 1 THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END"
GEO_SQL = f"""CASE WHEN count(*) {ROWS_BEFORE} = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, sqrt(power(latitude - avg(latitude) {ROWS_BEFORE}, 2) + power(longitude - avg(longitude) {ROWS_BEFORE}, 2)) / 50) END"""
SHARE_SQL = f"coalesce(count(*) {BACK_30_CHANNEL} / nullif(count(*) {BACK_30}, 0)::DOUBLE, 0.0::DOUBLE)"
DEVIATION_SQL = "CASE WHEN n < 5 OR mean = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, abs(amount - mean) / mean) END"
MERCHANT_SQL = """md AS (SELECT merchant, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS f FROM txn GROUP BY ALL),
  mr AS (SELECT merchant, day, CAST(sum(f) OVER w AS DOUBLE) / sum(n) OVER w AS score FROM md
    WINDOW w AS (PARTITION BY merchant ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _velocity(hours):
    @query(f"velocity_{hours}h", txn(f"""SELECT transaction_id, count(*) {_range(hours * HOUR_US - 1)} AS velocity_{hours}h FROM txn"""))
    def _(spark, d):
        return f.velocity(lean(spark, d), hours).select("transaction_id", f"velocity_{hours}h")


_velocity(1)
_velocity(24)


@query("merchant_risk_score", txn(f"""WITH {MERCHANT_SQL} SELECT transaction_id, round(coalesce(score, 0.5), 8) AS merchant_risk_score
  FROM txn LEFT JOIN mr ON mr.merchant = txn.merchant AND mr.day = CAST(txn.ts AS DATE)"""))
def _(spark, d):
    return f.merchant_risk_asof(lean(spark, d)).select("transaction_id", F.round("merchant_risk_score", 8).alias("merchant_risk_score"))


@query("time_since_last_txn", txn(f"SELECT transaction_id, round({GAP_SQL}, 8) AS time_since_last_txn FROM txn"))
def _(spark, d):
    return f.time_since_last_txn(lean(spark, d)).select("transaction_id", F.round("time_since_last_txn", 8).alias("time_since_last_txn"))


@query("time_since_prev2_1h", txn(f"""WITH p AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts, 2) {ORDERED}) AS age FROM txn)
  SELECT transaction_id, round(CASE WHEN age < {HOUR_US} THEN age / 1000000 / 86400 ELSE 1.0::DOUBLE END, 8) AS time_since_prev2_1h FROM p"""))
def _(spark, d):
    return f.time_since_second_last(lean(spark, d)).select("transaction_id", F.round("time_since_prev2_1h", 8).alias("time_since_prev2_1h"))


@query("amount_vs_avg_30d", txn(f"""WITH h AS (SELECT *, count(*) {BACK_30} AS n, {MEAN_SQL} AS mean FROM txn)
  SELECT transaction_id, round({DEVIATION_SQL}, 8) AS amount_vs_avg_30d FROM h"""))
def _(spark, d):
    return f.amount_vs_avg(lean(spark, d)).select("transaction_id", F.round("amount_vs_avg_30d", 8).alias("amount_vs_avg_30d"))


@query("amount_vs_avg_7d", txn(f"""WITH h AS (SELECT *, count(*) {_range(7 * DAY_US)} AS n,
  CAST(sum({money_sql('amount')}) {_range(7 * DAY_US)} AS DOUBLE) / nullif(count({money_sql('amount')}) {_range(7 * DAY_US)}, 0) AS mean FROM txn)
  SELECT transaction_id, round({DEVIATION_SQL}, 8) AS amount_vs_avg FROM h"""))
def _(spark, d):
    return f.amount_vs_avg(lean(spark, d), days=7).select("transaction_id", F.round("amount_vs_avg_30d", 8).alias("amount_vs_avg"))


@query("channel_frequency", txn(f"SELECT transaction_id, round({SHARE_SQL}, 8) AS channel_frequency_score FROM txn"))
def _(spark, d):
    return f.channel_frequency(lean(spark, d)).select("transaction_id", F.round("channel_frequency_score", 8).alias("channel_frequency_score"))


@query("geo_anomaly", txn(f"SELECT transaction_id, round({GEO_SQL}, 6) AS geo_anomaly_score FROM txn"))
def _(spark, d):
    return f.geo_anomaly(lean(spark, d)).select("transaction_id", F.round("geo_anomaly_score", 6).alias("geo_anomaly_score"))


@query("device_match", txn(f"SELECT transaction_id, {DEVICE_SQL} AS device_fingerprint_match FROM txn"))
def _(spark, d):
    return f.device_match(lean(spark, d)).select("transaction_id", "device_fingerprint_match")


FEATURES_SQL = f"""WITH {MERCHANT_SQL},
  h AS (SELECT *, count(*) {_range(HOUR_US - 1)} AS velocity, count(*) {BACK_30} AS n, {MEAN_SQL} AS mean, {GEO_SQL} AS geo,
    {DEVICE_SQL} AS device, {GAP_SQL} AS gap, {SHARE_SQL} AS share FROM txn),
  feats AS (SELECT transaction_id, is_fraud, amount AS transaction_amount, CAST(velocity AS DOUBLE) AS velocity_1h, coalesce(score, 0.5) AS merchant_risk_score,
    geo AS geo_anomaly_score, device AS device_fingerprint_match, gap AS time_since_last_txn, {DEVIATION_SQL} AS amount_vs_avg_30d,
    share AS channel_frequency_score, CAST(hour(ts) AS DOUBLE) AS hour_of_day, CAST(isodow(ts) - 1 AS DOUBLE) AS day_of_week,
    CAST(amount > 500 AS DOUBLE) AS is_high_amount, CAST(region IN ('AMERICA', 'ASIA', 'MIDDLE EAST') AS DOUBLE) AS is_cross_border
    FROM h LEFT JOIN mr ON mr.merchant = h.merchant AND mr.day = CAST(h.ts AS DATE))"""


@query("transaction_features", txn(f"""{FEATURES_SQL}
  SELECT transaction_id, {", ".join(f"round({n}, 6) AS {n}" for n in FEATURES)} FROM feats"""))
def _(spark, d):
    rows = f.transaction_features(lean(spark, d), regions=user_regions(spark, d), cross_border=GEO_CROSS_BORDER)
    return rows.select("transaction_id", *[F.round(n, 6).alias(n) for n in FEATURES])


@query("model_input", txn(f"""{FEATURES_SQL}
  SELECT {", ".join(f"round({n}, 6) AS {n}" for n in FEATURES[:8])} FROM feats"""))
def _(spark, d):
    from riskweave.operators.projections import MODEL_INPUT

    rows = f.transaction_features(lean(spark, d), regions=user_regions(spark, d), cross_border=GEO_CROSS_BORDER)
    return rows.select(*[F.round(n, 6).alias(n) for n in MODEL_INPUT])


@query("correlation_with_label", txn(FEATURES_SQL + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, CASE WHEN min({n}) = max({n}) THEN NULL ELSE round(corr({n}, CAST(is_fraud AS DOUBLE)), 6) END AS r FROM feats"
    for n in FEATURES)))
def _(spark, d):
    rows = f.transaction_features(lean(spark, d), regions=user_regions(spark, d), cross_border=GEO_CROSS_BORDER, keep=["is_fraud"])
    return aggregates.correlation_with_label(rows, FEATURES).withColumn("r", F.round("r", 6))


@query("sequence_window", txn("""WITH s AS (SELECT transaction_id, is_fraud, count(*) OVER w AS n, first_value(amount) OVER w AS first_amount, last_value(amount) OVER w AS last_amount,
    first_value(risk_score) OVER w AS first_risk, last_value(risk_score) OVER w AS last_risk, sum(risk_score) OVER w AS risk_total FROM txn
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, transaction_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
  SELECT transaction_id, is_fraud, CAST(n AS INTEGER) AS length, first_amount, last_amount, CAST(first_risk AS DOUBLE) AS first_risk, CAST(last_risk AS DOUBLE) AS last_risk,
    CAST(risk_total AS DOUBLE) AS risk_total FROM s WHERE n = 10"""))
def _(spark, d):
    rows = f.sequence_window(lean(spark, d), ["amount", "risk_score"])
    first, last = F.element_at("sequence", 1), F.element_at("sequence", -1)
    return rows.select(
        "transaction_id", "is_fraud", F.size("sequence").alias("length"), first[0].alias("first_amount"), last[0].alias("last_amount"),
        first[1].alias("first_risk"), last[1].alias("last_risk"),
        F.aggregate("sequence", F.lit(0.0), lambda total, x: total + x[1]).alias("risk_total"))


def _change_sql(field, name):
    return f"""WITH g AS (SELECT *, lag({field}) {ORDERED} AS old, row_number() {ORDERED} - 1 AS steps FROM txn)
  SELECT transaction_id, round(coalesce(sum(CAST(coalesce(old <> {field}, false) AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, transaction_id) / nullif(steps, 0)::DOUBLE, 0), 8) AS {name} FROM g"""


@query("region_change_rate", txn(_change_sql("region", "region_change_rate")))
def _(spark, d):
    rows = f.change_rate(transactions(spark, d), "region", "region_change_rate")
    return rows.select("transaction_id", F.round("region_change_rate", 8).alias("region_change_rate"))


@query("merchant_change_rate", txn(_change_sql("merchant", "merchant_change_rate")))
def _(spark, d):
    rows = f.change_rate(lean(spark, d), "merchant", "merchant_change_rate")
    return rows.select("transaction_id", F.round("merchant_change_rate", 8).alias("merchant_change_rate"))


@query("device_reuse", txn("""WITH u AS (SELECT device_id, count(DISTINCT user_id) AS device_users FROM txn GROUP BY 1)
  SELECT transaction_id, device_id, device_users FROM txn JOIN u USING (device_id)"""))
def _(spark, d):
    return f.device_reuse(lean(spark, d)).select("transaction_id", "device_id", "device_users")


def _first_use(entity):
    return f"CAST(row_number() OVER (PARTITION BY {entity}, user_id ORDER BY ts, transaction_id) = 1 AS INTEGER)"


def _users_before(entity, first):
    frame = f"(PARTITION BY {entity} ORDER BY ts, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN {entity} IS NOT NULL THEN CAST(coalesce(sum({first}) OVER {frame}, 0) AS BIGINT) END AS {entity}_users"


@query("users_before", txn(f"""WITH n AS (SELECT *, {_first_use('device_id')} AS d, {_first_use('merchant')} AS m FROM txn)
  SELECT transaction_id, {_users_before('device_id', 'd')}, {_users_before('merchant', 'm')} FROM n"""))
def _(spark, d):
    rows = lean(spark, d).select("transaction_id", "user_id", "ts", "device_id", "merchant")
    known = f.users_before(f.users_before(rows, "device_id", "device_id_users"), "merchant", "merchant_users")
    return known.select("transaction_id", "device_id_users", "merchant_users")


@query("amount_ratio_30d", txn(f"SELECT transaction_id, round(amount / nullif({MEAN_SQL}, 0), 8) AS amount_ratio_30d FROM txn"))
def _(spark, d):
    return f.amount_ratio(lean(spark, d)).select("transaction_id", F.round("amount_ratio_30d", 8).alias("amount_ratio_30d"))


@query("channel_diversity", txn("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, channel ORDER BY ts, transaction_id) AS k FROM txn)
  SELECT transaction_id, CAST(sum(CAST(k = 1 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, transaction_id) AS BIGINT) AS channel_diversity FROM n"""))
def _(spark, d):
    return f.channel_diversity(lean(spark, d)).select("transaction_id", F.col("channel_diversity").cast("long").alias("channel_diversity"))
