"""Row-wise operators: clean, enrich, classify and select."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions import columns as c
from riskweave.functions.stats import exact_percentiles
from riskweave.schemas import CROSS_BORDER_REGIONS, TRANSACTION


def parse_transactions(raw: DataFrame, schema=TRANSACTION, keep_unreadable: bool = True) -> DataFrame:
    """JSON in `value` → one column per field. Unreadable JSON gives a row of nulls."""
    rows = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")
    return rows if keep_unreadable else rows.where(F.col("is_fraud").isNotNull())


def with_event_time(df: DataFrame, text: str = "timestamp", name: str = "event_time") -> DataFrame:
    return df.withColumn(name, c.event_time(F.col(text)))


def enrich_transactions(df: DataFrame, cross_border: Iterable[str] = CROSS_BORDER_REGIONS) -> DataFrame:
    """Amount class, large-amount and cross-border flags, risk level."""
    return df.withColumns({
        "amount_category": c.amount_category(F.col("amount")),
        "is_high_amount": c.is_high_amount(F.col("amount")),
        "is_cross_border": c.is_cross_border(F.col("region"), cross_border),
        "risk_level": c.risk_level(F.col("risk_score")),
    })


def etl_transform(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Calendar parts, log amount and the right-closed risk class."""
    return df.withColumns({
        "hour": c.hour_of_day(F.col(ts)),
        "day_of_week": c.day_of_week(F.col(ts)),
        "is_weekend": c.is_weekend(F.col(ts)),
        "amount_log": F.log1p("amount"),
        "risk_category": c.risk_category(F.col("risk_score")),
    })


def enrich_payments(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "amount_category": c.amount_category(F.col("amount")),
        "is_high_amount": c.is_high_amount(F.col("amount")),
        "is_high_risk_type": c.high_risk_type(F.col("type")),
        "balance_discrepancy": c.balance_discrepancy(
            F.col("oldbalanceOrg"), F.col("newbalanceOrig"), F.col("amount")
        ),
    })


def balance_features(df: DataFrame) -> DataFrame:
    amount, old, dest = F.col("amount"), F.col("oldbalanceOrg"), F.col("oldbalanceDest")
    return df.withColumns({
        "balance_change_orig": old - F.col("newbalanceOrig"),
        "balance_change_dest": dest - F.col("newbalanceDest"),
        "is_dest_new": F.coalesce((dest == 0).cast("int"), F.lit(0)),
        "amount_to_balance_ratio": F.try_divide(amount, old + 1),
    })


def type_one_hot(df: DataFrame) -> DataFrame:
    return df.withColumns(c.type_flags(F.col("type")))


def clean_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({n: c.finite_or_zero(F.col(n)) for n in names})


def high_amount_p95(df: DataFrame, p: float = 0.95, amounts: DataFrame | None = None, **sizes: int) -> DataFrame:
    """1 where the amount lies above the interpolated percentile of the whole column. `amounts` may be a table of the
    same amounts that takes fewer joins than `df`; `written=True` says that it, or `df` without it, is a written table."""
    limit = exact_percentiles(df if amounts is None else amounts, "amount", {"_limit": p}, **sizes)
    return df.crossJoin(F.broadcast(limit)).withColumn(
        "is_high_amount", F.coalesce((F.col("amount") > F.col("_limit")).cast("int"), F.lit(0))
    ).drop("_limit")


def transaction_filter(
    df: DataFrame,
    status: str | None = None,
    min_risk: int | None = None,
    fraud_only: bool = False,
    limit: int = 50,
    ts: str = "ts",
) -> DataFrame:
    """Newest rows that meet the given conditions; an empty or zero condition is off."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    if status:
        df = df.where(F.col("status") == status)
    if min_risk:
        df = df.where(F.col("risk_score") >= min_risk)
    if fraud_only:
        df = df.where("is_fraud")
    return df.orderBy(F.desc(ts), F.desc("transaction_id")).limit(limit)


def transaction_search(
    df: DataFrame, status: str | None = None, risk: str | None = None, search: str | None = None
) -> DataFrame:
    """Dashboard search: status, risk band and a case-blind substring of id, merchant or user."""
    bands: dict[str, Column] = {
        "HIGH": F.col("risk_score") >= 72,
        "CRITICAL": F.col("risk_score") >= 85,
        "LOW": F.col("risk_score") < 30,
    }
    if status:
        df = df.where(F.col("status") == status)
    if risk:
        df = df.where(bands[risk])
    if search:
        needle = F.lit(search.upper())
        hit = [F.upper(F.col(n).cast("string")).contains(needle) for n in ("transaction_id", "merchant", "user_id")]
        df = df.where(hit[0] | hit[1] | hit[2])
    return df


def time_range(df: DataFrame, start: str, end: str, ts: str = "ts") -> DataFrame:
    """Rows of a closed time range, ready for a re-run."""
    return df.where(F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


# Column lists and names of the outward interfaces.
MODEL_INPUT = [
    "transaction_amount", "velocity_1h", "merchant_risk_score", "geo_anomaly_score",
    "device_fingerprint_match", "time_since_last_txn", "amount_vs_avg_30d", "channel_frequency_score",
]
MONITOR = ["transaction_id", "user_id", "amount", "merchant", "region", "channel", "risk_score", "is_fraud"]
API_NAMES = {
    "transaction_id": "id", "fraud_type": "fraudType", "risk_score": "riskScore",
    "user_id": "userId", "is_fraud": "isFraud",
}


def rename_api(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(API_NAMES)


def cold_start_features(df: DataFrame, ts: str = "ts", cross_border: Iterable[str] = CROSS_BORDER_REGIONS) -> DataFrame:
    """The feature vector of a transaction without any history."""
    return df.select(
        "transaction_id",
        F.col("amount").alias("transaction_amount"),
        F.lit(0.0).alias("velocity_1h"),
        F.lit(0.5).alias("merchant_risk_score"),
        F.lit(0.0).alias("geo_anomaly_score"),
        F.lit(0.8).alias("device_fingerprint_match"),
        F.lit(1.0).alias("time_since_last_txn"),
        F.lit(0.0).alias("amount_vs_avg_30d"),
        F.lit(0.0).alias("channel_frequency_score"),
        c.hour_of_day(F.col(ts)).cast("double").alias("hour_of_day"),
        c.day_of_week(F.col(ts)).cast("double").alias("day_of_week"),
        c.is_high_amount(F.col("amount")).cast("double").alias("is_high_amount"),
        c.is_cross_border(F.col("region"), cross_border).cast("double").alias("is_cross_border"),
    )
