"""Stream sinks. Every query gets its own checkpoint; two queries must never share one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskweave.operators.alerts import alert_rule
from riskweave.schemas import TOPICS
from riskweave.streaming.lifecycle import wait


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """The whole row as JSON in `value`, with an optional message key."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def route_topics(df: DataFrame, alert: Column | None = None) -> DataFrame:
    """One stream for two topics: every row for the raw topic, high-risk rows for alerts as well.

    The topic is a column of the messages, so one query and one read of the source serve both.
    """
    alert = alert_rule("fraud_and_gt80") if alert is None else alert
    topics = F.array_compact(F.array(F.lit(TOPICS["raw"]), F.when(alert, F.lit(TOPICS["alerts"]))))
    value = F.to_json(F.struct(*df.columns))
    return df.select(F.explode(topics).alias("topic"), value.alias("value"))


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A fixed interval, or everything available now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def json_value_sink(
    df: DataFrame, kind: str, target: str, checkpoint: str, key: str | None = None,
    every: str | None = None, mode: str = "append", **options: str,
) -> StreamingQuery:
    """Rows as JSON messages to a topic (`kind="kafka"`) or as text files with one message a line."""
    messages = to_messages(df, key if kind == "kafka" else None)
    writer = messages.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if kind == "kafka":
        writer = writer.format("kafka").option("topic", target).options(**options)
    else:
        writer = writer.format("text").option("path", target)
    return _triggered(writer, every).start()


def table_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = None, mode: str = "append") -> StreamingQuery:
    """Micro-batches as partitions `batch=<id>`; a repeated batch replaces its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _triggered(writer, every).start()


def latest_rows(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """The state of an update-mode table: the last written row per key."""
    rows = spark.read.parquet(path)
    rest = [n for n in rows.columns if n not in (*key, "batch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*key, "_last.*")


def debug_sink(df: DataFrame, kind: str, name: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Console output, or an in-memory table `name` to query; for looking at small streams only."""
    writer = df.writeStream.format(kind).outputMode(mode)
    if kind == "memory":
        writer = writer.queryName(name)
    return _triggered(writer, every).start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries that stop by themselves; the first that fails stops the others and is raised."""
    wait(*queries)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
