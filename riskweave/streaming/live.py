"""Live metrics over a stream: trailing means, throughput, newest rows per key and running totals.

Each micro-batch is joined with the few rows or totals that the batches before it handed on, and goes
through the same balanced operators as a whole table. What is handed on is bounded by the frame (the last 100 rows, 60 rows,
n rows a key, one row of totals), never by the length of the stream. Batches follow each other in event
order; a row that comes later than rows of an earlier batch is placed among its own batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.aggregates import etl_batch_stats
from riskweave.operators.running import recent_per_key, running_totals, throughput, trailing_latency
from riskweave.streaming.sinks import _triggered
from riskweave.streaming.state import BUCKETS, CarriedRows, KeyedTable, MetricCache


def _each(df: DataFrame, handle, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return _triggered(writer, every).start()


def recent_table(spark: SparkSession, path: str, key: Sequence[str], schema: T.StructType, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, f"{path}/recent", key, schema, buckets)


def _with_tail(columns: Sequence[str], path: str, keep: int, compute: Callable[[DataFrame], DataFrame], key: Sequence[str], ts: str):
    """A handler that computes on the carried rows and the batch, and hands on the newest `keep` rows, of each key if there is one."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns).persist()
        spark = batch.sparkSession
        try:
            timed = rows.where(F.col(ts).isNotNull())
            if key:
                table = recent_table(spark, path, key, rows.schema)
                past = table.read(batch_id, table.touched(rows))
            else:
                carried = CarriedRows(spark, f"{path}/carried", rows.schema)
                past = carried.before(batch_id)
            both = past.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
            compute(both).where("_new").drop("_new").write.mode("overwrite").parquet(f"{path}/out/micro={batch_id}")
            if key:
                cut = lambda some: recent_per_key(some, key, keep, ts).drop("rank", "_new")
                table.merge(cut(timed), batch_id, cut)
            else:
                carried.hand_on(past.unionByName(timed).orderBy(F.desc(ts), F.desc("transaction_id")).limit(keep), batch_id)
        finally:
            rows.unpersist()

    return handle


def latency_stream(df: DataFrame, path: str, checkpoint: str, last: int = 100, key: Sequence[str] = (), ts: str = "ts",
                   every: str | None = None) -> StreamingQuery:
    """`trailing_latency` of every record as it arrives; at most `last` - 1 rows (of each key) are carried."""
    columns = ["transaction_id", *key, ts, "processing_ms"]
    handle = _with_tail(columns, path, max(last - 1, 1), lambda rows: trailing_latency(rows, last, key, ts), key, ts)
    return _each(df, handle, checkpoint, every)


def throughput_stream(df: DataFrame, path: str, checkpoint: str, seconds: int = 60, cap: int = 60, ts: str = "ts",
                      every: str | None = None) -> StreamingQuery:
    """`throughput` of every record as it arrives; as it is capped, the newest `cap` rows are enough to carry."""
    handle = _with_tail(["transaction_id", ts], path, cap, lambda rows: throughput(rows, seconds, cap, ts), (), ts)
    return _each(df, handle, checkpoint, every)


def recent_stream(df: DataFrame, path: str, checkpoint: str, key: Sequence[str], n: int, ts: str = "ts", every: str | None = None,
                  buckets: int = BUCKETS) -> StreamingQuery:
    """The newest `n` rows of each key, kept up to date in `recent_table`. A batch is cut to `n` rows a key
    first, and rewrites only the buckets of its keys."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        cut = lambda rows: recent_per_key(rows, key, n, ts).drop("rank", "_new")
        recent_table(batch.sparkSession, path, key, batch.schema, buckets).merge(cut(batch), batch_id, cut)

    return _each(df, handle, checkpoint, every)


def newest(table: KeyedTable, ts: str = "ts") -> DataFrame:
    """The rows of a `recent_table` with their rank, 1 for the newest."""
    order = Window.partitionBy(*table.key).orderBy(F.desc(ts), F.desc("transaction_id"))
    return table.read().withColumn("rank", F.row_number().over(order))


TOTALS = "batch long, total long, fraud long, risk_sum double, scored long"
_SUMS = ("total", "fraud", "risk_sum", "scored")


def counters_stream(df: DataFrame, path: str, checkpoint: str, size: int = 100, every: str | None = None) -> StreamingQuery:
    """`running_counters` after each `size` transactions. Two rows are carried: the totals of all closed
    groups, and the group that is still open.

    An open group is written again when more of it comes; `latest_counters` reads its last state.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = T._parse_datatype_string(TOTALS)
        carried = CarriedRows(spark, f"{path}/carried", schema)
        held = {r["batch"] is None: r for r in carried.before(batch_id).collect()}  # two rows at most
        start, open_ = held.get(True), held.get(False)
        stats = etl_batch_stats(batch, "transaction_id", size).selectExpr("CAST(batch AS long) AS batch", "total", "fraud", "CAST(risk_sum AS double) AS risk_sum", "scored")
        if open_ is not None:
            stats = stats.unionByName(spark.createDataFrame([open_], schema))
        groups = stats.where("batch IS NOT NULL").groupBy("batch").agg(*[F.sum(n).alias(n) for n in _SUMS]).persist()
        try:
            running_totals(groups, start).write.mode("overwrite").parquet(f"{path}/out/micro={batch_id}")
            last = groups.orderBy(F.desc("batch")).limit(1).collect()
            if last:
                closed = groups.where(F.col("batch") < last[0]["batch"]).agg(*[F.sum(n).alias(n) for n in _SUMS]).first()
                total = [None, *[(closed[n] or 0) + (start[n] if start is not None else 0) for n in _SUMS]]
                carried.hand_on(spark.createDataFrame([tuple(total), tuple(last[0])], schema), batch_id)
        finally:
            groups.unpersist()

    return _each(df, handle, checkpoint, every)


def latest_counters(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/out")
    rest = [n for n in rows.columns if n not in ("batch", "micro")]
    return rows.groupBy("batch").agg(F.max_by(F.struct(*rest), "micro").alias("_last")).select("batch", "_last.*")


def metrics_stream(df: DataFrame, path: str, checkpoint: str, ttl_seconds: int = 3600, ts: str = "ts", every: str | None = None) -> StreamingQuery:
    """A gauge per user (last processing time, with a lifetime) and the counters of all and of fraudulent transactions
    (without one), kept in two `MetricCache` tables at `path`; the newest time of a batch is its clock."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("user_id", "processing_ms", "is_fraud", ts).where(F.col(ts).isNotNull()).persist()
        try:
            now = rows.agg(F.max(ts)).first()[0]
            if now is None:
                return
            gauges, counters = metric_caches(batch.sparkSession, path)
            name = F.concat(F.lit("metrics:latency:"), F.col("user_id").cast("string"))
            gauges.set(rows.select(name.alias("name"), F.col("processing_ms").cast("double").alias("value"), F.col(ts).alias("updated_at")),
                       batch_id, F.lit(now), ttl_seconds)
            steps = F.array(
                F.struct(F.lit("etl:total_count").alias("name"), F.lit(1.0).alias("value")),
                F.struct(F.lit("etl:fraud_count").alias("name"), F.col("is_fraud").cast("double").alias("value")))
            counters.increment(rows.select(F.explode(steps).alias("_s"), F.col(ts).alias("updated_at")).select("_s.*", "updated_at"), batch_id, F.lit(now))
        finally:
            rows.unpersist()

    return _each(df, handle, checkpoint, every)


def metric_caches(spark: SparkSession, path: str) -> tuple[MetricCache, MetricCache]:
    return MetricCache(spark, f"{path}/gauges"), MetricCache(spark, f"{path}/counters", buckets=4)
