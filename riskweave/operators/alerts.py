"""Alert rules, alert records and handlers."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions import columns as c

log = logging.getLogger(__name__)


def alert_rule(name: str, threshold_risk: int = 80) -> Column:
    """Three rules are in use: producer, stream (with a threshold) and predictor."""
    risk, fraud = F.col("risk_score"), F.col("is_fraud")
    rules = {
        "fraud_and_gt80": fraud & (risk > 80),
        "ge80": risk >= threshold_risk,
        "fraud_or_gt72": fraud | (risk > 72),
    }
    return rules[name]


def alert_candidates(df: DataFrame, rule: str = "fraud_and_gt80", threshold_risk: int = 80) -> DataFrame:
    return df.where(alert_rule(rule, threshold_risk))


def _or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("unknown")).alias(name)


def alert_payload(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Alert record of a transaction. alert_id is a short name for people, made of the transaction and
    its time; joins and deduplication go by transaction_id."""
    stamp = F.concat(F.col("transaction_id").cast("string"), c.iso(F.col(ts)))
    kind = c.text_or_none(F.col("fraud_type"))
    return df.select(
        F.substring(F.sha2(stamp, 256), 1, 8).alias("alert_id"),
        "transaction_id",
        _or_unknown("fraud_type"),
        "risk_score",
        _or_unknown("merchant"),
        "user_id",
        _or_unknown("region"),
        F.col(ts).alias("timestamp"),
        F.concat(F.lit("HIGH RISK: "), kind, F.lit(" detected on "), c.text_or_none(F.col("merchant"))).alias("message"),
        F.lit(False).alias("acknowledged"),
    )


def predictor_alert_payload(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Alert record of a prediction: keyed by transaction, worded by score and user."""
    user = c.text_or_none(F.col("user_id").cast("string"))
    return df.select(
        F.col("transaction_id").alias("alert_id"),
        "transaction_id",
        "user_id",
        F.coalesce("fraud_type", F.lit("Suspicious")).alias("fraud_type"),
        "risk_score",
        F.coalesce("merchant", F.lit("N/A")).alias("merchant"),
        F.col(ts).alias("timestamp"),
        F.concat(F.lit("HIGH RISK: risk_score="), F.col("risk_score").cast("string"), F.lit(" for "), user).alias("message"),
    )


def fired_rules(df: DataFrame) -> DataFrame:
    """One row per transaction and rule it meets, so a transaction may appear up to three times."""
    names = ["fraud_and_gt80", "ge80", "fraud_or_gt72"]
    met = F.array_compact(F.array(*[F.when(alert_rule(n), F.lit(n)) for n in names]))
    return df.withColumn("rule", F.explode(met))


def dedupe_alerts(alerts: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keep one alert per transaction: the first rule name in order."""
    others = [n for n in alerts.columns if n not in (key, "rule")]
    kept = alerts.groupBy(key).agg(F.min(F.struct("rule", *others)).alias("_first"))
    return kept.select(key, "_first.*")


def retained_alerts(alerts: DataFrame, as_of: Column, days: int = 7, created: str = "created_at") -> DataFrame:
    return alerts.where(F.col(created) > as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def acknowledge(alerts: DataFrame, acknowledged: DataFrame) -> DataFrame:
    """Set the flag on alerts listed in `acknowledged` (column transaction_id).

    An alert is known by its transaction: the short alert_id is for display and may clash.
    """
    marks = acknowledged.select("transaction_id").distinct().withColumn("_ack", F.lit(True))
    marked = alerts.join(marks, "transaction_id", "left").withColumn("acknowledged", F.coalesce("_ack", "acknowledged"))
    return marked.select(*alerts.columns)


class AlertHandlers:
    """Callbacks for the alerts of a micro-batch; a failing one does not stop the others."""

    def __init__(self) -> None:
        self.handlers: list[Callable[[DataFrame, int], None]] = []
        self.errors: deque[Exception] = deque(maxlen=100)  # the latest

    def register(self, handler: Callable[[DataFrame, int], None]) -> None:
        self.handlers.append(handler)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for handler in self.handlers:
                try:
                    handler(batch, batch_id)
                except Exception as error:
                    self.errors.append(error)
                    log.warning("alert handler failed on batch %s: %s", batch_id, error)
        finally:
            batch.unpersist()
