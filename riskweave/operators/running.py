"""Trailing and running metrics over the whole stream of records or per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window, functions as F

from riskweave.functions import columns as c
from riskweave.functions.history import Measure, before, with_blocks
from riskweave.operators.aggregates import etl_batch_stats

_ALL = ["_all"]
GROUP_LIMIT = 1000  # spark.sql.optimizer.windowGroupLimitThreshold


def _numbered(df: DataFrame, key: Sequence[str], time: str, ident: str, **sizes: int) -> DataFrame:
    return before(df, key, time, ident, [Measure("_position", F.lit(1))], **sizes)


def trailing_latency(df: DataFrame, last: int = 100, key: Sequence[str] = (), ts: str = "ts", block: int = 4096, **sizes: int) -> DataFrame:
    """Mean processing time of the latest `last` records, this one included.

    Without a key there is one global order. It is still spread out: positions come from balanced
    running counts, and the frame runs over blocks of consecutive positions. A record without a
    time has no mean and counts in none.
    """
    key = list(key)
    rows = df.withColumns({"_us": c.micros(F.col(ts)), "_all": F.lit(0)})
    numbered = _numbered(rows, key or _ALL, "_us", "transaction_id", **sizes)
    blocks = with_blocks(numbered, key or _ALL, "_position", last - 1, block)
    window = Window.partitionBy(*(key or _ALL), "_block").orderBy("_position").rowsBetween(-(last - 1), 0)
    total, count = F.sum("processing_ms").over(window), F.count("processing_ms").over(window)
    mean = F.when(F.col("_position").isNotNull(), F.try_divide(total, count))
    return blocks.withColumn("avg_latency_ms", mean).where(~F.col("_lead_in")).select(
        *df.columns, "avg_latency_ms"
    )


def throughput(df: DataFrame, seconds: int = 60, cap: int = 60, ts: str = "ts", **sizes: int) -> DataFrame:
    """Records of the last `seconds` seconds, both ends and this one included, at most `cap`."""
    rows = df.withColumns({"_us": c.micros(F.col(ts)), "_all": F.lit(0)})
    counted = before(rows, _ALL, "_us", "transaction_id", [Measure("_n", F.lit(1), seconds * c.MICROS, True)], **sizes)
    return counted.withColumn("throughput", F.least(F.lit(cap), F.col("_n") + 1)).drop("_n", "_us", "_all")


def recent_per_key(df: DataFrame, key: Sequence[str], n: int, ts: str = "ts", ident: str = "transaction_id") -> DataFrame:
    """The newest `n` rows per key. Up to the planner's group limit (1,000) the rank filter goes below
    the exchange; beyond, rows are first cut to `n` per key and input partition, then per
    key and a sixty-fourth of these, so that no task holds more of a hot key than its share."""
    def cut(rows: DataFrame, *parts: str) -> DataFrame:
        newest = Window.partitionBy(*key, *parts).orderBy(F.desc(ts), F.desc(ident))
        return rows.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)

    if n <= GROUP_LIMIT:
        return cut(df)
    rows = df.withColumn("_part", F.spark_partition_id())
    rows = rows.withColumn("_some", F.col("_part") % 64)
    return cut(cut(cut(rows, "_part"), "_some")).drop("_part", "_some")


def running_counters(df: DataFrame, sequence: str = "transaction_id", size: int = 100, **sizes: int) -> DataFrame:
    """Totals after each batch, the batch's own mean risk and the true running mean."""
    return running_totals(etl_batch_stats(df, sequence, size), **sizes)


def running_totals(batches: DataFrame, start: Row | None = None, **sizes: int) -> DataFrame:
    """`running_counters` of rows (batch, total, fraud, risk_sum, scored), on top of the totals in `start`."""
    first = {n: 0 if start is None else start[n] for n in ("total", "fraud", "risk_sum", "scored")}
    past = before(
        batches.withColumn("_all", F.lit(0)), _ALL, "batch", "batch",
        [Measure("_t", F.col("total")), Measure("_f", F.col("fraud")), Measure("_r", F.col("risk_sum")), Measure("_s", F.col("scored"))],
        **sizes,
    )
    upto = lambda past, own: F.col(past) + F.col(own) + F.lit(first[own])
    return past.select(
        "batch",
        upto("_t", "total").alias("total_count"),
        upto("_f", "fraud").alias("fraud_count"),
        F.try_divide("risk_sum", "scored").alias("batch_avg_risk"),
        F.try_divide(upto("_r", "risk_sum"), upto("_s", "scored")).alias("running_avg_risk"),
    )
