"""Target tables: transactions, predictions, alerts and metrics."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskweave.operators.projections import etl_transform
from riskweave.schemas import STORED_TRANSACTION
from riskweave.sources.folders import drop_folder, folder_values


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, batch_rows: int = 10_000) -> None:
    """Append to a database table. Tasks write in parallel, each in batched inserts."""
    options = {"batchsize": str(batch_rows), **(properties or {})}
    df.write.jdbc(url, table, mode="append", properties=options)


def stored_transactions(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows in the form of the transactions table, with its defaults for missing values."""
    rows = df.withColumnRenamed(ts, "timestamp") if ts != "timestamp" else df
    defaults = {"risk_score": F.lit(0), "is_fraud": F.lit(False), "timestamp": F.current_timestamp()}
    columns = []
    for field in STORED_TRANSACTION:
        value = F.col(field.name)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name])
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def stored_predictions(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Predictions in the form of their table: fixed-point probability, scores and factors as text."""
    return df.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("fraud_probability").cast(T.DecimalType(6, 4)).alias("fraud_probability"),
        "risk_score",
        "is_fraud",
        F.to_json("model_scores").alias("model_scores"),
        F.concat_ws(",", "contributing_factors").alias("factors"),
        (F.current_timestamp() if ts is None else ts).alias("timestamp"),
    )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def partition_days(spark: SparkSession, path: str, name: str) -> list[date]:
    """The days that have a folder `name=<day>` in a table."""
    return sorted(date.fromisoformat(v) for v in folder_values(spark, path, name) if v[:4].isdigit())


def backfill(rows: DataFrame, path: str, first: date, last: date, derive: Callable[[DataFrame], DataFrame] = etl_transform, ts: str = "ts") -> list[date]:
    """Derive the days `first` to `last` of the table at `path` (a folder `day=` each) anew from `rows`; returns the days that now have rows.

    The range reaches the scan of `rows` as a filter on `ts`. Each day is replaced as a whole, days of the range without rows go, all
    others keep their files. Doing it again changes nothing.
    """
    spark = rows.sparkSession
    inside = (F.col(ts) >= F.lit(datetime.combine(first, datetime.min.time()))) & (F.col(ts) < F.lit(datetime.combine(last, datetime.min.time()) + timedelta(days=1)))
    made = derive(rows.where(inside)).withColumn("day", F.to_date(ts))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    found = {r[0] for r in rows.where(inside).select(F.to_date(ts)).distinct().collect()}  # one row a day of the range
    for day in partition_days(spark, path, "day"):
        if first <= day <= last and day not in found:
            drop_folder(spark, f"{path}/day={day.isoformat()}")
    return sorted(found)


class AlertStore:
    """Alerts with at most one row per transaction, partitioned by day.

    Repeats inside a batch and alerts already stored are skipped, so a replayed batch adds nothing.
    Alerts expire after `days`; only the days still kept are read for the check, which bounds it.
    """

    def __init__(self, spark: SparkSession, path: str, days: int = 7):
        self.spark, self.path, self.days = spark, path, days

    def read(self, schema: T.StructType) -> DataFrame:
        return read_or_empty(self.spark, self.path, schema)

    def append(self, alerts: DataFrame, created_at: Column | None = None) -> None:
        """Of several alerts for a transaction the smallest row is kept, whatever their order."""
        stamp = F.current_timestamp() if created_at is None else created_at
        rest = [n for n in alerts.columns if n != "transaction_id"]
        first = alerts.groupBy("transaction_id").agg(F.min(F.struct(*rest)).alias("_first")).select("transaction_id", "_first.*")
        fresh = (
            first.select(*alerts.columns).withColumn("created_at", stamp).withColumn("created_day", F.to_date("created_at")).persist()
        )
        try:
            oldest = fresh.agg(F.min("created_day")).first()[0]
            if oldest is None:
                return
            kept = self.read(fresh.schema).where(F.col("created_day") >= F.date_sub(F.lit(oldest), self.days))
            # Only stored ids that occur in this batch go into the anti join, however large the table is.
            known = kept.select("transaction_id").join(fresh.select("transaction_id"), "transaction_id", "left_semi")
            new = fresh.join(known, "transaction_id", "left_anti")
            new.write.mode("append").partitionBy("created_day").parquet(self.path)
            self.expire(fresh.agg(F.max("created_at")).first()[0])
        finally:
            fresh.unpersist()

    def expire(self, as_of: datetime) -> list[date]:
        """Delete the days whose alerts have all outlived the retention at `as_of`; returns them. The driver
        looks at one folder a day, and no younger day is touched."""
        last = (as_of - timedelta(days=self.days)).date()
        gone = [d for d in partition_days(self.spark, self.path, "created_day") if d < last]
        for day in gone:
            drop_folder(self.spark, f"{self.path}/created_day={day.isoformat()}")
        return gone

    def current(self, schema: T.StructType, as_of: Column) -> DataFrame:
        """Alerts younger than the retention, whole expired days pruned by partition."""
        oldest = as_of - F.expr(f"INTERVAL {int(self.days)} DAYS")
        rows = self.read(schema)
        return rows.where((F.col("created_day") >= F.to_date(oldest)) & (F.col("created_at") > oldest))


def _alive(df: DataFrame, stamp: str, as_of: Column | DataFrame, ttl_seconds: int) -> DataFrame:
    """Rows whose lifetime has not passed. `as_of` is a column or a one-row frame with `now`."""
    if isinstance(as_of, DataFrame):
        df, now = df.crossJoin(F.broadcast(as_of.select("now"))), F.col("now")
    else:
        now = as_of
    return df.where(F.col(stamp) + F.make_dt_interval(secs=F.lit(ttl_seconds)) > now)


def metric_snapshot(metrics: DataFrame, as_of: Column | DataFrame, ttl_seconds: int = 3600) -> DataFrame:
    """Latest value per metric name; names not updated within the lifetime are gone."""
    latest = metrics.groupBy("name").agg(
        F.max_by("value", "updated_at").alias("value"), F.max("updated_at").alias("updated_at")
    )
    return _alive(latest, "updated_at", as_of, ttl_seconds).select("name", "value", "updated_at")


def counter_totals(increments: DataFrame) -> DataFrame:
    """Counters as the sum of their appended increments (name, value)."""
    return increments.groupBy("name").agg(F.sum("value").alias("value"))


def latest_prediction(predictions: DataFrame, as_of: Column | DataFrame, ttl_seconds: int = 3600) -> DataFrame:
    """Last prediction per transaction that is still within its lifetime."""
    rest = [n for n in predictions.columns if n not in ("transaction_id", "scored_at")]
    latest = predictions.groupBy("transaction_id").agg(
        F.max("scored_at").alias("scored_at"), F.max_by(F.struct(*rest), "scored_at").alias("_last")
    )
    return _alive(latest, "scored_at", as_of, ttl_seconds).select("transaction_id", "scored_at", "_last.*")
