"""Lookups and joins. No side is broadcast by hand here unless its size is fixed; the planner
broadcasts below its threshold and splits skewed partitions above it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskweave.functions import columns as c


def predictions_with_transactions(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    return predictions.join(transactions, "transaction_id")


def orphan_predictions(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Predictions whose transaction does not exist."""
    return predictions.join(transactions.select("transaction_id"), "transaction_id", "left_anti")


def known_device(df: DataFrame, devices: DataFrame) -> DataFrame:
    """0.0 for a device listed for the user, else 0.8."""
    known = devices.select("user_id", "device_id").distinct().withColumn("_known", F.lit(True))
    return df.join(known, ["user_id", "device_id"], "left").withColumn(
        "device_fingerprint_match", F.when(F.col("_known"), 0.0).otherwise(0.8)
    ).drop("_known")


def merchant_score_lookup(df: DataFrame, scores: DataFrame, default: float = 0.5) -> DataFrame:
    """Attach each merchant's score (columns merchant, score)."""
    return df.join(scores.select("merchant", F.col("score").alias("_score")), "merchant", "left").withColumn(
        "merchant_risk_score", F.coalesce("_score", F.lit(default))
    ).drop("_score")


def merchant_daily_counts(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.groupBy("merchant", F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"), F.count_if("is_fraud").alias("fraud")
    )


def merchant_daily_rates(daily: DataFrame) -> DataFrame:
    """(merchant, day, fraud rate of all earlier days), one row per merchant and active day.

    The window sees days, not transactions, so a merchant with very many rows costs no more.
    """
    past = Window.partitionBy("merchant").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(
        "merchant", "day", F.try_divide(F.sum("fraud").over(past), F.sum("n").over(past)).alias("score")
    )


def merchant_risk_asof(df: DataFrame, ts: str = "ts", default: float = 0.5, daily: DataFrame | None = None) -> DataFrame:
    """Fraud rate the merchant had before the transaction's day; `default` on its first day.

    `daily` holds the counts the rates come from when they cover more than `df` itself.
    """
    rates = merchant_daily_rates(merchant_daily_counts(df, ts) if daily is None else daily)
    scored = df.withColumn("day", F.to_date(ts)).join(rates, ["merchant", "day"], "left")
    return scored.withColumn("merchant_risk_score", F.coalesce("score", F.lit(default))).drop("day", "score")


def hourly_rate_aligned(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Fraud count over all counts by hour; hours without fraud read 0. One pass, no join."""
    return df.groupBy(F.hour(ts).alias("hour")).agg(
        F.coalesce(F.try_divide(F.count_if("is_fraud"), F.count("*")), F.lit(0.0)).alias("fraud_rate")
    )


def grid_complete(df: DataFrame, row: str, column: str, rows: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every row × column cell of the listed values, with zeros where no data fell, and every other
    cell that occurs; missing values are cells of their own."""
    cells = df.groupBy(row, column).agg(F.count("*").alias("total"), F.count_if("is_fraud").alias("fraud"))
    spark = df.sparkSession
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in rows])).alias(row)).select(
        row, F.explode(F.array(*[F.lit(v) for v in columns])).alias(column)
    )
    found = cells.withColumnsRenamed({row: "_row", column: "_column"})
    same = F.col(row).eqNullSafe(F.col("_row")) & F.col(column).eqNullSafe(F.col("_column"))
    both = grid.withColumn("_listed", F.lit(True)).join(found, same, "full")
    own = {n: F.when(F.col("_listed"), F.col(n)).otherwise(F.col(f)) for n, f in ((row, "_row"), (column, "_column"))}
    return both.withColumns(own).drop("_listed", "_row", "_column").na.fill(0, ["total", "fraud"])


def heatmap_cells(df: DataFrame, rows: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Region × channel cells with the fraud share as a whole percentage."""
    cells = grid_complete(df, "region", "channel", rows, columns)
    share = F.when(F.col("total") > 0, F.round(F.col("fraud") * 100.0 / F.col("total"))).otherwise(0.0)
    return cells.withColumn("pct", share.cast("int"))


def user_stats(df: DataFrame) -> DataFrame:
    """Per-user totals attached to predictions."""
    return df.groupBy("user_id").agg(
        F.count("*").alias("user_txns"),
        F.round(c.money_avg(F.col("amount")), 4).alias("user_avg_amount"),
        F.count_if("is_fraud").alias("user_frauds"),
    )


def with_user_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Works on a batch and, with a static `stats`, on a stream."""
    return df.join(stats, "user_id", "left")
