"""Streaming queries: each runs its stream to the end of the events and returns what it wrote.

They read the same table as the batch queries and must give the same rows. Output goes to tables in
the shared folder, each run in a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave.functions import columns as c
from riskweave.functions.stats import discrete_percentiles
from riskweave.operators import projections as p
from riskweave.operators.joins import user_stats, with_user_stats
from riskweave.plans.registry import iso_sql, money_avg_sql, query, txn
from riskweave.plans.rows import ENRICH_SQL, json_messages
from riskweave.plans.windows import (
    LABEL_SQL, METRICS, METRICS_SQL, RUNNING_SQL, SLIDING, SLIDING_SQL, TUMBLING, TUMBLING_SQL, flat,
)
from riskweave.plans.features import FEATURES_SQL
from riskweave.schemas import FEATURES, GEO_CROSS_BORDER, TOPICS, TRANSACTION
from riskweave.session import shared_dir
from riskweave.sources.stores import AlertStore
from riskweave.sources.tables import as_transactions, table, transactions, user_regions
from riskweave.streaming import aggregates as w, jobs, live as metrics, sinks
from riskweave.streaming.history import BoundedHistory
from riskweave.streaming.refreshed import VersionedTable, refreshed_join
from riskweave.streaming.sources import is_folder, stream_source


# Bounds a micro-batch, so that a long table is read in several.
BATCH = {"maxBytesPerTrigger": str(16 << 30)}


def live(spark: SparkSession, folder: str, region: bool = True) -> DataFrame:
    """The events as a stream, joined with the static region table.

    A table is a folder of part files, which is streamed itself, or a single file, which only
    a pattern over its folder can name.
    """
    path = f"{folder}/events.parquet"
    place = {"path": path} if is_folder(spark, path) else {"path": folder, "pathGlobFilter": "events.parquet"}
    events = stream_source(spark, "parquet", table(spark, folder, "events").schema, **place, **BATCH)
    rows = as_transactions(events)
    return rows.join(user_regions(spark, folder), "user_id", "left") if region else rows


def fresh(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def updated(spark, aggregated, key):
    """Run an aggregate in update mode and return its final state."""
    path = fresh(spark)
    sinks.finish(jobs.aggregate_stream(aggregated, f"{path}/out", f"{path}/checkpoint"))
    return sinks.latest_rows(spark, f"{path}/out", key)


@query("stream_sliding_region_channel", SLIDING_SQL)
def _(spark, d):
    return flat(updated(spark, w.sliding_region_channel(live(spark, d)), ["window", "region", "channel"]), *SLIDING)


@query("stream_tumbling_fraud_5m", TUMBLING_SQL)
def _(spark, d):
    return flat(updated(spark, w.tumbling_fraud(live(spark, d)), ["window", "region", "fraud_type"]), *TUMBLING)


@query("stream_realtime_metrics_1m", METRICS_SQL)
def _(spark, d):
    return flat(updated(spark, w.realtime_metrics(live(spark, d, region=False)), ["window"]), *METRICS)


@query("stream_sliding_type_label", LABEL_SQL)
def _(spark, d):
    out = updated(spark, w.sliding_type_label(live(spark, d, region=False)), ["window", "channel", "is_fraud"])
    return flat(out, "channel", "is_fraud", "count")


@query("stream_latency_percentiles", txn("""SELECT CAST(hour(ts) AS INTEGER) AS hour, count(processing_ms) AS count,
  CAST(quantile_disc(processing_ms, 0.5) AS DOUBLE) AS p50_ms, CAST(quantile_disc(processing_ms, 0.99) AS DOUBLE) AS p99_ms FROM txn GROUP BY 1"""))
def _(spark, d):
    """Counts per value and minute, kept by the stream, merged to hours of the day; exact at any number of rows."""
    minutes = updated(spark, w.latency_counts(live(spark, d, region=False)), ["window", "processing_ms"])
    hours = minutes.select(F.hour("window.start").alias("hour"), "processing_ms", "n")
    return discrete_percentiles(hours, {"p50_ms": 0.5, "p99_ms": 0.99}, ["hour"], "processing_ms")


@query("stream_running_fraud_counts", RUNNING_SQL)
def _(spark, d):
    return updated(spark, w.running_fraud_counts(live(spark, d)), ["region", "fraud_type"])


@query("stream_enrich", txn(f"SELECT transaction_id, amount, region, risk_score, {ENRICH_SQL} FROM txn"))
def _(spark, d):
    path = fresh(spark)
    rows = live(spark, d).select("transaction_id", "amount", "region", "risk_score")
    sinks.finish(jobs.enrich_stream(rows, "text", f"{path}/out", f"{path}/checkpoint", GEO_CROSS_BORDER, every=None))
    schema = p.enrich_transactions(rows, GEO_CROSS_BORDER).schema
    return p.parse_transactions(spark.read.text(f"{path}/out"), schema)


@query("stream_alerts", txn(f"SELECT transaction_id, user_id, risk_score, {iso_sql('ts')} AS ts FROM txn WHERE risk_score >= 80"))
def _(spark, d):
    path = fresh(spark)
    rows = live(spark, d, region=False).select("transaction_id", "user_id", "risk_score", c.iso(F.col("ts")).alias("ts"))
    sinks.finish(jobs.alert_stream(rows, "text", f"{path}/out", f"{path}/checkpoint", every=None))
    return p.parse_transactions(spark.read.text(f"{path}/out"), rows.schema)


@query("stream_parse", txn("""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, amount, channel, risk_score, is_fraud FROM txn"""))
def _(spark, d):
    path = fresh(spark)
    parsed = p.parse_transactions(json_messages(live(spark, d)), TRANSACTION)
    sinks.finish(sinks.table_sink(parsed, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("transaction_id", "amount", "channel", "risk_score", "is_fraud")


@query("stream_topics", txn(f"""SELECT '{TOPICS['raw']}' AS topic, transaction_id, risk_score FROM txn UNION ALL
  SELECT '{TOPICS['alerts']}', transaction_id, risk_score FROM txn WHERE is_fraud AND risk_score > 80"""))
def _(spark, d):
    path = fresh(spark)
    rows = live(spark, d, region=False).select("transaction_id", "risk_score", "is_fraud")
    sinks.finish(sinks.table_sink(sinks.route_topics(rows), f"{path}/out", f"{path}/checkpoint"))
    value = F.from_json("value", "transaction_id bigint, risk_score int")
    return spark.read.parquet(f"{path}/out").select("topic", value.alias("v")).select("topic", "v.*")


@query("stream_deduplicated", txn("SELECT transaction_id, user_id, amount FROM txn"))
def _(spark, d):
    path = fresh(spark)
    rows = live(spark, d, region=False)
    twice = rows.withColumn("_again", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_again")
    sinks.finish(sinks.table_sink(jobs.deduplicated(twice), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("transaction_id", "user_id", "amount")


USER_STATS_SQL = txn(f"""SELECT transaction_id, user_txns, user_avg_amount, user_frauds FROM txn JOIN (SELECT user_id, count(*) AS user_txns,
  round({money_avg_sql('amount')}, 4) AS user_avg_amount, count(*) FILTER (WHERE is_fraud) AS user_frauds FROM txn GROUP BY 1) USING (user_id)""")


@query("stream_user_stats", USER_STATS_SQL)
def _(spark, d):
    path = fresh(spark)
    joined = with_user_stats(live(spark, d, region=False), user_stats(transactions(spark, d, region=False)))
    sinks.finish(sinks.table_sink(joined, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("transaction_id", "user_txns", "user_avg_amount", "user_frauds")


@query("stream_refreshed_user_stats", USER_STATS_SQL)
def _(spark, d):
    path = fresh(spark)
    totals = VersionedTable(spark, f"{path}/totals")
    totals.publish(user_stats(transactions(spark, d, region=False)))
    sinks.finish(refreshed_join(live(spark, d, region=False), totals, ["user_id"], f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("transaction_id", "user_txns", "user_avg_amount", "user_frauds")


@query("stream_scores", txn(f"""SELECT transaction_id, least(1.0::DOUBLE, amount / 1000.0) AS fraud_probability FROM txn"""))
def _(spark, d):
    path = fresh(spark)
    store = AlertStore(spark, f"{path}/alerts", days=36_500)
    sinks.finish(jobs.score_stream(
        live(spark, d), BoundedHistory(f"{path}/history"), f"{path}/predictions", store, f"{path}/checkpoint",
        cross_border=GEO_CROSS_BORDER))
    made = spark.read.parquet(f"{path}/predictions")
    return made.select(F.col("transaction_id").cast("long").alias("transaction_id"), "fraud_probability")


@query("stream_scored_alerts", txn("""SELECT CAST(transaction_id AS VARCHAR) AS alert_id, coalesce(fraud_type, 'Suspicious') AS fraud_type, merchant, risk AS risk_score,
  'HIGH RISK: risk_score=' || risk || ' for ' || user_id AS message FROM (SELECT *, least(1.0::DOUBLE, amount / 1000.0) AS p,
  least(99, CAST(trunc(least(1.0::DOUBLE, amount / 1000.0) * 100) AS INTEGER)) AS risk FROM txn) WHERE p > 0.5 OR risk > 72"""))
def _(spark, d):
    """What the scoring stream raises, as its messages to the alert topic say it."""
    path = fresh(spark)
    sinks.finish(jobs.score_stream(
        live(spark, d), BoundedHistory(f"{path}/history"), f"{path}/predictions", AlertStore(spark, f"{path}/alerts"),
        f"{path}/checkpoint", cross_border=GEO_CROSS_BORDER, publish=jobs.topic_writer(f"{path}/topics", "parquet")))
    value = F.from_json("value", "alert_id string, fraud_type string, merchant string, risk_score int, message string")
    sent = spark.read.parquet(f"{path}/topics").where(F.col("topic") == TOPICS["alerts"])
    return sent.select(value.alias("v")).select("v.*")


@query("stream_features", txn(f"""{FEATURES_SQL} SELECT transaction_id, {", ".join(f"round({n}, 6) AS {n}" for n in FEATURES)} FROM feats"""))
def _(spark, d):
    path = fresh(spark)
    sinks.finish(jobs.score_stream(
        live(spark, d), BoundedHistory(f"{path}/history"), f"{path}/features", AlertStore(spark, f"{path}/alerts"),
        f"{path}/checkpoint", score=jobs.with_fallback, cross_border=GEO_CROSS_BORDER))
    rows = spark.read.parquet(f"{path}/features")
    return rows.select("transaction_id", *[F.round(n, 6).alias(n) for n in FEATURES])


@query("stream_etl", txn("""SELECT transaction_id // 100 AS batch_no, count(*) AS total, count(*) FILTER (WHERE is_fraud) AS fraud FROM txn GROUP BY 1"""))
def _(spark, d):
    path = fresh(spark)
    store = AlertStore(spark, f"{path}/alerts")
    sinks.finish(jobs.micro_batch_etl(live(spark, d), path, store, f"{path}/checkpoint"))
    parts = spark.read.parquet(f"{path}/metrics/batch=*")
    return parts.groupBy(F.col("batch").alias("batch_no")).agg(F.sum("total").alias("total"), F.sum("fraud").alias("fraud"))


@query("stream_trailing_latency", txn("""SELECT transaction_id, round(avg(processing_ms) OVER (ORDER BY ts, transaction_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS avg_latency_ms FROM txn"""))
def _(spark, d):
    path = fresh(spark)
    sinks.finish(metrics.latency_stream(live(spark, d, region=False), path, f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("transaction_id", F.round("avg_latency_ms", 6).alias("avg_latency_ms"))


@query("stream_throughput_60s", txn("""SELECT transaction_id, least(60, count(*) OVER (ORDER BY epoch_us(ts) RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW)) AS throughput FROM txn"""))
def _(spark, d):
    path = fresh(spark)
    sinks.finish(metrics.throughput_stream(live(spark, d, region=False), path, f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("transaction_id", F.col("throughput").cast("long").alias("throughput"))


@query("stream_recent_per_user", txn("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, transaction_id DESC) AS rank FROM txn)
  SELECT user_id, CAST(rank AS INTEGER) AS rank, transaction_id, risk_score FROM k WHERE rank <= 8"""))
def _(spark, d):
    path = fresh(spark)
    rows = live(spark, d, region=False).select("user_id", "transaction_id", "risk_score", "ts")
    sinks.finish(metrics.recent_stream(rows, path, f"{path}/checkpoint", ["user_id"], 8))
    table = metrics.recent_table(spark, path, ["user_id"], rows.schema)
    return metrics.newest(table).select("user_id", "rank", "transaction_id", "risk_score")


@query("stream_running_counters", txn("""WITH b AS (SELECT transaction_id // 100 AS batch, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS f, sum(risk_score) AS r FROM txn GROUP BY 1)
  SELECT batch, CAST(sum(n) OVER w AS BIGINT) AS total_count, CAST(sum(f) OVER w AS BIGINT) AS fraud_count, CAST(r AS DOUBLE) / n AS batch_avg_risk,
  CAST(sum(r) OVER w AS DOUBLE) / sum(n) OVER w AS running_avg_risk FROM b WINDOW w AS (ORDER BY batch)"""))
def _(spark, d):
    path = fresh(spark)
    sinks.finish(metrics.counters_stream(live(spark, d, region=False), path, f"{path}/checkpoint"))
    return metrics.latest_counters(spark, path)


@query("stream_metric_cache", txn("""WITH n AS (SELECT max(ts) AS now FROM txn)
  SELECT 'metrics:latency:' || user_id AS name, CAST(arg_max(processing_ms, ts) AS DOUBLE) AS value FROM txn GROUP BY user_id
    HAVING max(ts) + INTERVAL 36000 SECOND > (SELECT now FROM n)
  UNION ALL SELECT 'etl:total_count', CAST(count(*) AS DOUBLE) FROM txn UNION ALL SELECT 'etl:fraud_count', CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) FROM txn"""))
def _(spark, d):
    path = fresh(spark)
    rows = live(spark, d, region=False)
    sinks.finish(metrics.metrics_stream(rows, path, f"{path}/checkpoint", 36_000))
    now = transactions(spark, d, region=False).agg(F.max("ts").alias("now")).first()["now"]
    gauges, counters = metrics.metric_caches(spark, path)
    return gauges.read(F.lit(now)).unionByName(counters.read(F.lit(now))).select("name", "value")
