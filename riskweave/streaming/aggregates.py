"""Windowed aggregations that run unchanged on a stream and on a table.

`watermark=None` is the batch form. On a stream the watermark bounds the state: windows older than
the newest event time minus the delay are closed and their late rows dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.functions import columns as c
from riskweave.functions.stats import sketched


def _late_after(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df if delay is None else df.withWatermark(ts, delay)


def sliding_region_channel(df: DataFrame, ts: str = "ts", watermark: str | None = "30 seconds") -> DataFrame:
    """30-second windows every 15 seconds per region and channel.

    `avg_fraud_amount` spreads fraud amounts over all transactions: others count as 0.
    """
    amount, fraud = F.col("amount"), F.col("is_fraud")
    return _late_after(df, ts, watermark).groupBy(F.window(ts, "30 seconds", "15 seconds"), "region", "channel").agg(
        F.count("*").alias("total_transactions"),
        c.money_sum(amount).alias("total_amount"),
        F.round(c.money_avg(amount), 4).alias("avg_amount"),
        F.count_if(fraud).alias("fraud_count"),
        F.round(c.money_sum(F.when(fraud, amount).otherwise(0.0)) / F.count("*"), 4).alias("avg_fraud_amount"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
    )


def tumbling_fraud(df: DataFrame, ts: str = "ts", watermark: str | None = "10 minutes") -> DataFrame:
    """Fraud per 5-minute window, region and type. The filter comes first, so only fraud is kept as state."""
    frauds = _late_after(df.where("is_fraud"), ts, watermark)
    return frauds.groupBy(F.window(ts, "5 minutes"), "region", "fraud_type").agg(
        F.count("*").alias("fraud_count"),
        F.round(c.money_avg(F.col("amount")), 4).alias("avg_fraud_amount"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
    )


def realtime_metrics(df: DataFrame, ts: str = "ts", watermark: str | None = "10 minutes") -> DataFrame:
    """Volume, fraud, risk, amount and latency per minute."""
    return _late_after(df, ts, watermark).groupBy(F.window(ts, "1 minute")).agg(
        F.count("*").alias("txn_count"),
        F.count_if("is_fraud").alias("fraud_count"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk"),
        F.round(c.money_avg(F.col("amount")), 4).alias("avg_amount"),
        F.round(F.avg("processing_ms"), 4).alias("avg_latency_ms"),
    )


def sliding_type_label(df: DataFrame, kind: str = "channel", ts: str = "ts", watermark: str | None = "1 minute") -> DataFrame:
    """30-second windows every 10 seconds per kind and label."""
    return _late_after(df, ts, watermark).groupBy(F.window(ts, "30 seconds", "10 seconds"), kind, "is_fraud").agg(
        F.count("*").alias("count")
    )


def latency_sketches(df: DataFrame, ts: str = "ts", watermark: str | None = "10 minutes") -> DataFrame:
    """A mergeable quantile sketch of the processing time per minute, for percentiles of any span of minutes."""
    return _late_after(df, ts, watermark).groupBy(F.window(ts, "1 minute")).agg(
        F.count("processing_ms").alias("count"), sketched("processing_ms").alias("sketch")
    )


def latency_counts(df: DataFrame, ts: str = "ts", watermark: str | None = "10 minutes") -> DataFrame:
    """How often each processing time occurs per minute, for exact percentiles of any span of minutes. Times are whole
    milliseconds, so the state holds a row per value, not per record."""
    return _late_after(df, ts, watermark).groupBy(F.window(ts, "1 minute"), "processing_ms").agg(F.count("*").alias("n"))


def running_fraud_counts(df: DataFrame) -> DataFrame:
    """Fraud counts per region and type since the start; a small, unwindowed state."""
    return df.where("is_fraud").groupBy("region", "fraud_type").agg(F.count("*").alias("count"))
