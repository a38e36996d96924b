"""Streams on several micro-batches give the batch result; late rows, replays and repeats are handled."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.models import learn
from riskweave.models.ensemble import batch_predict
from riskweave.models.forest import IsolationForest
from riskweave.operators import aggregates as a, alerts
from riskweave.operators.features import sequence_window, transaction_features
from riskweave.operators.joins import user_stats
from riskweave.operators.projections import enrich_transactions
from riskweave.schemas import ALERT, FEATURES, GEO_CROSS_BORDER, TOPICS
from riskweave.session import materialize
from riskweave.sources.stores import AlertStore
from riskweave.sources.tables import transactions
from riskweave.streaming import aggregates as w, jobs, sinks
from riskweave.streaming.sources import kafka_options, replay, stream_source


@pytest.fixture(scope="module")
def files(spark, small, tmp_path_factory):
    """The transactions in time order as four files, one per micro-batch."""
    folder = str(tmp_path_factory.mktemp("files"))
    rows = transactions(spark, small)
    for k in range(4):
        part = rows.where(F.floor(F.col("transaction_id") / 250) == k)
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def live(spark, files):
    schema = spark.read.parquet(files).schema
    return stream_source(spark, "parquet", schema, path=files, maxFilesPerTrigger="1")


def as_set(df):
    return {tuple(str(x) for x in r) for r in df.collect()}


@pytest.mark.parametrize("build,key", [
    (w.sliding_region_channel, ["window", "region", "channel"]),
    (w.tumbling_fraud, ["window", "region", "fraud_type"]),
    (w.realtime_metrics, ["window"]),
    (w.sliding_type_label, ["window", "channel", "is_fraud"]),
])
def test_windowed_streams_equal_batch(spark, files, tmp_path, build, key):
    query = jobs.aggregate_stream(build(live(spark, files)), f"{tmp_path}/out", f"{tmp_path}/cp")
    sinks.finish(query)
    assert len(query.recentProgress) >= 4
    batch = build(spark.read.parquet(files), watermark=None)
    streamed = sinks.latest_rows(spark, f"{tmp_path}/out", key).select(*batch.columns)
    assert as_set(streamed) == as_set(batch)


def test_running_counts_in_complete_mode(spark, files):
    query = sinks.debug_sink(w.running_fraud_counts(live(spark, files)), "memory", "counts", mode="complete")
    sinks.finish(query)
    assert as_set(spark.sql("SELECT * FROM counts")) == as_set(w.running_fraud_counts(spark.read.parquet(files)))


def test_bursts_and_slow_windows_on_a_stream(spark, files, tmp_path):
    for k, build in enumerate((lambda df: a.fraud_burst(df, "1 day", 5), lambda df: a.latency_alert(df, "1 hour", 70))):
        stream = build(live(spark, files).withWatermark("ts", "1 day"))
        sinks.finish(jobs.aggregate_stream(stream, f"{tmp_path}/o{k}", f"{tmp_path}/c{k}"))
        batch = build(spark.read.parquet(files))
        assert batch.count() > 0
        assert as_set(sinks.latest_rows(spark, f"{tmp_path}/o{k}", ["window"]).select(*batch.columns)) >= as_set(batch)


def test_enriched_messages_equal_batch(spark, files, tmp_path):
    rows = live(spark, files).select("transaction_id", "amount", "region", "risk_score")
    sinks.finish(jobs.enrich_stream(rows, "text", f"{tmp_path}/out", f"{tmp_path}/cp", GEO_CROSS_BORDER, every=None))
    batch = enrich_transactions(spark.read.parquet(files).select("transaction_id", "amount", "region", "risk_score"), GEO_CROSS_BORDER)
    back = spark.read.text(f"{tmp_path}/out").select(F.from_json("value", batch.schema).alias("v")).select("v.*")
    assert as_set(back) == as_set(batch)


def test_alert_stream_takes_a_threshold(spark, files, tmp_path):
    sinks.finish(jobs.alert_stream(live(spark, files), "text", f"{tmp_path}/out", f"{tmp_path}/cp", 95, every=None))
    assert spark.read.text(f"{tmp_path}/out").count() == spark.read.parquet(files).where("risk_score >= 95").count()


def test_two_topics_from_one_stream(spark, files, tmp_path):
    sinks.finish(sinks.table_sink(sinks.route_topics(live(spark, files)), f"{tmp_path}/out", f"{tmp_path}/cp"))
    counts = {r["topic"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/out").groupBy("topic").count().collect()}
    assert counts[TOPICS["raw"]] == 1000
    assert counts[TOPICS["alerts"]] == alerts.alert_candidates(spark.read.parquet(files)).count()


def test_messages_carry_a_key(spark, files):
    row = sinks.to_messages(spark.read.parquet(files).select("user_id", "amount"), "user_id").first()
    assert row["key"] and row["value"].startswith("{")


def timed(spark, folder, batches):
    for k, times in enumerate(batches):
        rows = [(f"{k}-{i}", datetime(2024, 1, 1) + timedelta(seconds=s), "R", "C", 10.0, True, 50, 9) for i, s in enumerate(times)]
        df = spark.createDataFrame(rows, "transaction_id string, ts timestamp, region string, channel string, amount double, is_fraud boolean, risk_score int, processing_ms int")
        df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    """The limit a batch applies was set by the one before, so the late row comes two batches on."""
    schema = timed(spark, f"{tmp_path}/in", [[0, 5, 10], [600], [610], [3], [1200]])
    rows = stream_source(spark, "parquet", schema, path=f"{tmp_path}/in", maxFilesPerTrigger="1")
    sinks.finish(sinks.table_sink(w.realtime_metrics(rows, watermark="1 minute"), f"{tmp_path}/out", f"{tmp_path}/cp", mode="append"))
    out = {r["window"].start.minute: r["txn_count"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert out == {0: 3, 10: 2}


def test_repeated_ids_are_dropped_within_the_watermark(spark, tmp_path):
    schema = timed(spark, f"{tmp_path}/in", [[0, 1], [2]])
    spark.read.parquet(f"{tmp_path}/in").where("transaction_id = '0-0'").write.mode("append").parquet(f"{tmp_path}/in")
    rows = stream_source(spark, "parquet", schema, path=f"{tmp_path}/in", maxFilesPerTrigger="1")
    sinks.finish(sinks.table_sink(jobs.deduplicated(rows), f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("transaction_id").collect()) == ["0-0", "0-1", "1-0"]


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 20, "chunk_rows": 10}])
def test_scores_over_micro_batches_equal_one_batch(spark, files, tmp_path, sizes):
    store = AlertStore(spark, f"{tmp_path}/alerts")
    history = jobs.UserHistory(f"{tmp_path}/history")
    query = jobs.score_stream(live(spark, files), history, f"{tmp_path}/features", store, f"{tmp_path}/cp",
                              score=jobs.with_fallback, cross_border=GEO_CROSS_BORDER, **sizes)
    sinks.finish(query)
    streamed = spark.read.parquet(f"{tmp_path}/features")
    assert streamed.select("batch").distinct().count() == 4
    batch = transaction_features(spark.read.parquet(files), cross_border=GEO_CROSS_BORDER)
    names = ["transaction_id", *[F.round(n, 9).alias(n) for n in FEATURES if n != "merchant_risk_score"]]
    assert as_set(streamed.select(*names)) == as_set(batch.select(*names))
    # A day may be cut by a batch limit, yet only earlier days count: the merchant score agrees too.
    score = ["transaction_id", F.round("merchant_risk_score", 9)]
    assert as_set(streamed.select(*score)) == as_set(batch.select(*score))
    flagged = streamed.where("is_fraud OR risk_score > 72").count()
    assert store.read(spark.read.parquet(f"{tmp_path}/alerts").schema).count() == flagged > 0


def test_fitted_models_on_a_stream_equal_the_batch(spark, files, tmp_path):
    """Forest, trees and sequences over four micro-batches, with messages keyed by user."""
    rows = spark.read.parquet(files)
    table = materialize(transaction_features(rows, cross_border=GEO_CROSS_BORDER, keep=["is_fraud", "user_id", "ts"]))
    sequences = materialize(sequence_window(table))
    models = (
        IsolationForest.fit(table, FEATURES, trees=20), learn.fit_boosted(table, rounds=5, depth=3), learn.fit_sequence(sequences, rounds=5),
    )
    late = learn.sequence_scores(models[2], sequences).select("transaction_id", "lstm")
    scored = learn.boosted_scores(models[1], models[0].transform(table)).join(late, "transaction_id", "left")
    want = {r["transaction_id"]: (r["fraud_probability"], r["risk_score"]) for r in batch_predict(scored).collect()}

    query = jobs.score_stream(
        live(spark, files), jobs.UserHistory(f"{tmp_path}/history"), f"{tmp_path}/made", AlertStore(spark, f"{tmp_path}/alerts"),
        f"{tmp_path}/cp", score=jobs.fitted_scorer(*models), sequences=True, cross_border=GEO_CROSS_BORDER,
        publish=jobs.topic_writer(f"{tmp_path}/topics", "parquet"), stats=user_stats(rows))
    sinks.finish(query)
    got = {r["transaction_id"]: (r["fraud_probability"], r["risk_score"]) for r in spark.read.parquet(f"{tmp_path}/made").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i][0] - want[i][0]) <= 2e-4 and abs(got[i][1] - want[i][1]) <= 1 for i in want)

    messages = spark.read.parquet(f"{tmp_path}/topics")
    counts = {r["topic"]: r["count"] for r in messages.groupBy("topic").count().collect()}
    assert counts[TOPICS["predictions"]] == len(want)
    assert counts[TOPICS["alerts"]] == spark.read.parquet(f"{tmp_path}/alerts").count() > 0
    users = {str(r["transaction_id"]): str(r["user_id"]) for r in rows.collect()}
    value = F.from_json("value", "transaction_id string, user_txns long, message string")
    for r in messages.select("topic", "key", value.alias("v")).select("topic", "key", "v.*").collect():
        assert r["key"] == users[r["transaction_id"]]
        assert r["user_txns"] > 0 if r["topic"] == TOPICS["predictions"] else r["message"].startswith("HIGH RISK: risk_score=")


def test_a_replayed_batch_changes_nothing(spark, files, tmp_path):
    history = jobs.UserHistory(f"{tmp_path}/history")
    rows = spark.read.parquet(files)
    old, new = rows.where("transaction_id < 600"), rows.where("transaction_id >= 600")
    history.append(old, 0)
    first = as_set(jobs.batch_features(new, 1, history))
    history.append(new, 1)
    assert as_set(jobs.batch_features(new, 1, history)) == first
    history.append(new, 1)
    assert spark.read.parquet(f"{tmp_path}/history/rows").count() == 1000


def test_history_can_be_limited_to_days(spark, files, tmp_path):
    history = jobs.UserHistory(f"{tmp_path}/history", days=3)
    rows = spark.read.parquet(files)
    history.append(rows.where("ts < '2024-01-20'"), 0)
    new = rows.where("ts >= '2024-01-20' AND ts < '2024-01-21'")
    past = history.rows_before(new, 1)
    assert past.agg(F.min(F.to_date("ts"))).first()[0].isoformat() >= "2024-01-17"
    assert past.columns == new.columns


def test_alert_store_keeps_one_alert_per_transaction(spark, small, tmp_path):
    store = AlertStore(spark, f"{tmp_path}/alerts")
    made = alerts.alert_payload(alerts.alert_candidates(transactions(spark, small)))
    made = made.withColumn("transaction_id", F.col("transaction_id").cast("string")).withColumn("user_id", F.col("user_id").cast("string"))
    assert made.schema.fieldNames() == ALERT.fieldNames()
    store.append(made.unionByName(made))
    n = made.count()
    schema = spark.read.parquet(f"{tmp_path}/alerts").schema
    assert store.read(schema).count() == n
    store.append(made)
    store.append(made.limit(0))
    assert store.read(schema).count() == n


def test_alert_retention(spark, tmp_path):
    store = AlertStore(spark, f"{tmp_path}/alerts")
    times = [datetime(2024, 1, 1), datetime(2024, 1, 7, 23), datetime(2024, 1, 8, 0, 0, 1), datetime(2024, 1, 14)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(times)], "transaction_id string, at timestamp")
    store.append(df, F.col("at"))
    schema = spark.read.parquet(f"{tmp_path}/alerts").schema
    kept = store.current(schema, F.lit(datetime(2024, 1, 15)))
    assert sorted(r["transaction_id"] for r in kept.collect()) == ["2", "3"]


def test_one_failing_handler_does_not_stop_the_rest(spark, files, tmp_path):
    handlers, seen = alerts.AlertHandlers(), []

    def broken(batch, batch_id):
        raise RuntimeError("no route")

    handlers.register(broken)
    handlers.register(lambda batch, batch_id: seen.append(batch.count()))
    chosen = alerts.alert_candidates(live(spark, files))
    query = chosen.writeStream.foreachBatch(handlers).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(seen) == alerts.alert_candidates(spark.read.parquet(files)).count()
    assert len(handlers.errors) == len(seen)


def test_micro_batch_etl_writes_three_targets(spark, files, tmp_path):
    store = AlertStore(spark, f"{tmp_path}/alerts")
    sinks.finish(jobs.micro_batch_etl(live(spark, files), str(tmp_path), store, f"{tmp_path}/cp"))
    stored = spark.read.parquet(f"{tmp_path}/transactions")
    assert stored.count() == 1000 and dict(stored.dtypes)["amount"] == "decimal(12,2)"
    assert spark.read.parquet(f"{tmp_path}/metrics/batch=*").agg(F.sum("total")).first()[0] == 1000
    assert spark.read.parquet(f"{tmp_path}/alerts").count() == spark.read.parquet(files).where("is_fraud").count()


def test_a_restart_goes_on_from_the_checkpoint(spark, small, tmp_path):
    rows = transactions(spark, small, region=False)
    rows.where("transaction_id < 500").coalesce(1).write.parquet(f"{tmp_path}/in")
    for expected in (500, 1000):
        stream = stream_source(spark, "parquet", rows.schema, path=f"{tmp_path}/in")
        sinks.finish(sinks.table_sink(stream, f"{tmp_path}/out", f"{tmp_path}/cp"))
        assert spark.read.parquet(f"{tmp_path}/out").count() == expected
        rows.where("transaction_id >= 500").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def test_bounded_replay_reads_every_message(spark, small, tmp_path):
    sample = transactions(spark, small, region=False).orderBy("transaction_id").limit(300)
    sinks.to_messages(sample.select("transaction_id", "amount")).write.text(f"{tmp_path}/topic")
    assert replay(spark, "text", path=f"{tmp_path}/topic").count() == 300


def test_console_sink_and_stop(spark, files, capsys):
    query = sinks.debug_sink(live(spark, files).select("transaction_id"), "console", "c", every="1 hour")
    assert query.isActive
    sinks.stop_all(spark)
    assert not query.isActive


def test_topic_options():
    options = kafka_options("broker:9092", TOPICS["raw"])
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false" and options["subscribe"] == "txn.raw"
