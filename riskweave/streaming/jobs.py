"""Streaming jobs: the batch operators on streams, with history and stores where they need memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.models.ensemble import batch_predict, fallback_score
from riskweave.models.forest import IsolationForest
from riskweave.models.learn import boosted_scores, sequence_scores
from riskweave.operators.alerts import alert_candidates, alert_payload, predictor_alert_payload
from riskweave.operators.aggregates import etl_batch_stats
from riskweave.operators.features import sequence_window, transaction_features
from riskweave.operators.joins import merchant_daily_counts, with_user_stats
from riskweave.operators.projections import enrich_transactions, etl_transform
from riskweave.schemas import CROSS_BORDER_REGIONS, TOPICS
from riskweave.sources.stores import AlertStore, read_or_empty, stored_predictions, stored_transactions
from riskweave.streaming.history import BoundedHistory
from riskweave.streaming.sinks import json_value_sink, table_sink


def enrich_stream(df: DataFrame, kind: str, target: str, checkpoint: str, cross_border: Iterable[str] = CROSS_BORDER_REGIONS,
                  every: str | None = "5 seconds", **options: str) -> StreamingQuery:
    """Enriched rows to their topic, without state."""
    return json_value_sink(enrich_transactions(df, cross_border), kind, target, checkpoint, every=every, **options)


def alert_stream(df: DataFrame, kind: str, target: str, checkpoint: str, threshold_risk: int = 80,
                 every: str | None = "2 seconds", **options: str) -> StreamingQuery:
    """High-risk rows to the alert topic, without state."""
    chosen = alert_candidates(df, "ge80", threshold_risk)
    return json_value_sink(chosen, kind, target, checkpoint, every=every, **options)


def deduplicated(df: DataFrame, ident: str = "transaction_id", ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """First row per id. The watermark bounds how long an id is remembered."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([ident])


@dataclass
class UserHistory:
    """Past transactions by day, for features that look back further than a micro-batch.

    A streaming range window does not exist, and keyed state would put a very active user into one
    task. Instead each batch reads the stored rows of its own users (by default all of them; with
    `days` only that many days, pruned by partition) and uses the same balanced features as a batch
    job. Merchant counts are kept as one row per merchant and day. Each batch owns its partitions,
    so a replay overwrites them and never sees itself as history.
    """

    path: str
    days: int | None = None

    def _stored(self, name: str, like: DataFrame, batch_id: int) -> DataFrame:
        schema = like.select(*[n for n in like.columns if n != "day"], F.lit(0).alias("batch"), "day").schema
        return read_or_empty(like.sparkSession, f"{self.path}/{name}", schema).where(F.col("batch") < batch_id).drop("batch")

    def rows_before(self, batch: DataFrame, batch_id: int, ts: str = "ts") -> DataFrame:
        rows = self._stored("rows", batch.withColumn("day", F.to_date(ts)), batch_id)
        if self.days is not None:
            first = batch.agg(F.min(F.to_date(ts))).first()[0]
            if first is not None:
                rows = rows.where(F.col("day") >= F.date_sub(F.lit(first), self.days))
        return rows.drop("day").join(batch.select("user_id").distinct(), "user_id", "left_semi")

    def merchant_days(self, batch: DataFrame, batch_id: int, ts: str = "ts") -> DataFrame:
        """Counts per merchant and day up to and including this batch."""
        new = merchant_daily_counts(batch, ts)
        both = self._stored("merchants", new, batch_id).unionByName(new)
        return both.groupBy("merchant", "day").agg(F.sum("n").alias("n"), F.sum("fraud").alias("fraud"))

    def append(self, batch: DataFrame, batch_id: int, ts: str = "ts") -> None:
        for name, rows in (("rows", batch.withColumn("day", F.to_date(ts))), ("merchants", merchant_daily_counts(batch, ts))):
            target = rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch", "day")
            target.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{name}")


def batch_features(
    batch: DataFrame, batch_id: int, history: UserHistory | BoundedHistory, ts: str = "ts", sequences: bool = False, **options
) -> DataFrame:
    """Features of a micro-batch as if it followed everything stored before it.

    With `sequences` also the previous feature rows of the user, null where there are too few.
    """
    past = history.rows_before(batch, batch_id, ts).withColumn("_new", F.lit(False))
    weight = "_weight" if "_weight" in past.columns else None
    if weight and sequences:
        raise ValueError("sequences need a UserHistory: features of rows however old")
    fresh = batch if weight is None else batch.withColumn(weight, F.lit(None).cast("long"))
    both = past.unionByName(fresh.withColumn("_new", F.lit(True)))
    daily = history.merchant_days(batch, batch_id, ts)
    keep = ["user_id", "amount", "_new", *([ts, "is_fraud"] if sequences else [])]
    rows = transaction_features(both, ts, merchant_daily=daily, keep=keep, weight=weight, **options)
    if sequences:
        known = sequence_window(rows, ts=ts, keep=["_new"]).where("_new").select("transaction_id", "sequence")
        rows = rows.join(known, "transaction_id", "left").drop(ts, "is_fraud")
    return rows.where("_new").drop("_new")


def fitted_scorer(forest: IsolationForest, boosted: PipelineModel, sequence: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """Scores feature rows with their `sequence` by three fitted models, combined as in a batch.

    Rows without a sequence are scored by the other two.
    """

    def score(rows: DataFrame) -> DataFrame:
        some = rows.where("sequence IS NOT NULL").withColumn("is_fraud", F.lit(None).cast("boolean"))
        late = sequence_scores(sequence, some).select("transaction_id", "lstm")
        scored = boosted_scores(boosted, forest.transform(rows.drop("sequence")))
        return batch_predict(scored.join(late, "transaction_id", "left"))

    return score


def topic_messages(batch: DataFrame, made: DataFrame, alerts: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """(topic, key, value): every prediction, with its user's totals when `stats` is given, and every
    alert, both keyed by user so that a user's messages stay in order."""
    users = batch.select(F.col("transaction_id").cast("string").alias("transaction_id"), "user_id")
    predictions = made.join(users, "transaction_id")
    predictions = predictions if stats is None else with_user_stats(predictions, stats)

    def to(topic: str, rows: DataFrame) -> DataFrame:
        value = F.to_json(F.struct(*rows.columns)).alias("value")
        return rows.select(F.lit(TOPICS[topic]).alias("topic"), F.col("user_id").cast("string").alias("key"), value)

    return to("predictions", predictions).unionByName(to("alerts", alerts))


def topic_writer(target: str, kind: str = "kafka", **options: str) -> Callable[[DataFrame, int], None]:
    """Writes the messages of a micro-batch to topics (`target` names the servers), or as files in their
    place, where a repeated batch replaces its own folder."""

    def write(messages: DataFrame, batch_id: int) -> None:
        if kind == "kafka":
            messages.write.format("kafka").option("kafka.bootstrap.servers", target).options(**options).save()
        else:
            messages.write.mode("overwrite").format(kind).save(f"{target}/batch={batch_id}")

    return write


def with_fallback(features: DataFrame) -> DataFrame:
    """Features kept next to the amount rule's decision."""
    return fallback_score(features).withColumnsRenamed({"is_fraud_predicted": "is_fraud", "predicted_risk": "risk_score"})


def score_stream(
    df: DataFrame, history: UserHistory | BoundedHistory, predictions: str, alerts: AlertStore, checkpoint: str,
    score: Callable[[DataFrame], DataFrame] = batch_predict, every: str | None = None, ts: str = "ts",
    publish: Callable[[DataFrame, int], None] | None = None, stats: DataFrame | None = None, **options,
) -> StreamingQuery:
    """Features → prediction → predictions table, alert store and topics, for each micro-batch.

    `score` maps feature rows to predictions; the default combines model scores where the columns
    exist and falls back to the amount rule, `fitted_scorer` uses fitted models (with
    `sequences=True`). `publish` gets the `topic_messages` of each batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            made = score(batch_features(batch, batch_id, history, ts, **options))
            made.write.mode("overwrite").parquet(f"{predictions}/batch={batch_id}")
            stored = batch.sparkSession.read.schema(made.schema).parquet(f"{predictions}/batch={batch_id}")
            flagged = stored.where(F.col("is_fraud") | (F.col("risk_score") > 72)).select("transaction_id", F.col("risk_score").alias("_risk"))
            rows = batch.withColumn("transaction_id", F.col("transaction_id").cast("string")).join(flagged, "transaction_id")
            raised = predictor_alert_payload(rows.withColumn("risk_score", F.col("_risk")), ts)
            alerts.append(raised)
            if publish is not None:
                publish(topic_messages(batch, stored, raised, stats), batch_id)
            history.append(batch, batch_id, ts)
        finally:
            batch.unpersist()

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def micro_batch_etl(
    df: DataFrame, folder: str, alerts: AlertStore, checkpoint: str, every: str | None = None, ts: str = "ts"
) -> StreamingQuery:
    """Each micro-batch to three targets: transactions, batch metrics and fraud alerts.

    The transformed batch is kept while the three are written, so it is computed once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = etl_transform(batch, ts).persist()
        try:
            stored_transactions(rows, ts).write.mode("overwrite").parquet(f"{folder}/transactions/batch={batch_id}")
            etl_batch_stats(rows).write.mode("overwrite").parquet(f"{folder}/metrics/batch={batch_id}")
            alerts.append(alert_payload(rows.where("is_fraud"), ts))
        finally:
            rows.unpersist()

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def prediction_rows(spark: SparkSession, predictions: str) -> DataFrame:
    return stored_predictions(spark.read.parquet(predictions))


def aggregate_stream(aggregated: DataFrame, path: str, checkpoint: str, every: str | None = None, mode: str = "update") -> StreamingQuery:
    """A windowed or running aggregate to a table; read it with `sinks.latest_rows`."""
    return table_sink(aggregated, path, checkpoint, every, mode)
