"""State that micro-batches carry: live metrics, keyed tables, expiry, backfill, restarts."""

import uuid
from collections import defaultdict
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.operators import running
from riskweave.session import shared_dir
from riskweave.sources.stores import AlertStore, backfill
from riskweave.sources.tables import transactions
from riskweave.streaming import lifecycle, live, sinks
from riskweave.streaming.refreshed import VersionedTable, refreshed_join
from riskweave.streaming.state import KeyedTable, MetricCache

PARTS = 5


def fresh(spark):
    return f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def in_order(spark, small):
    """The transactions as part files in event order, with a user and a merchant that own a third of them."""
    rows = transactions(spark, small, region=False).select("transaction_id", "user_id", "channel", "processing_ms", "risk_score", "is_fraud", "ts")
    rows = rows.withColumn("user_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(1).cast(rows.schema["user_id"].dataType)).otherwise(F.col("user_id")))
    ordered = rows.orderBy("ts", "transaction_id").collect()
    path, size = fresh(spark), -(-len(ordered) // PARTS)
    renumbered = [tuple([i, *r[1:]]) for i, r in enumerate(ordered)]  # ids rise with time, as the counters expect
    for k in range(PARTS):
        part = renumbered[k * size : (k + 1) * size]
        spark.createDataFrame(part, rows.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def batches(spark, in_order, start):
    """Run a stream over one file a micro-batch, stopped and started again half-way. Returns its folder."""
    table, source = in_order
    path, staged = fresh(spark), Path(fresh(spark).removeprefix("file:"))
    staged.mkdir(parents=True)
    files = sorted(Path(source.removeprefix("file:")).glob("*.parquet"), key=lambda f: spark.read.parquet(str(f)).agg(F.min("transaction_id")).first()[0])
    for half in (files[:2], files[2:]):
        for n, f in enumerate(half):
            (staged / f"{len(list(staged.iterdir())):03d}-{f.name}").write_bytes(f.read_bytes())
            stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(staged))
            sinks.finish(start(stream, path, f"{path}/checkpoint"))
    return path


def same(a, b):
    order = sorted(a.columns)
    rows = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(order).collect()), key=repr)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("key", [(), ("channel",)])
def test_streamed_latency_equals_the_batch_form(spark, in_order, key):
    path = batches(spark, in_order, lambda s, p, c: live.latency_stream(s, p, c, 100, key))
    columns = ["transaction_id", "avg_latency_ms"]
    same(spark.read.parquet(f"{path}/out").select(columns), running.trailing_latency(in_order[0], 100, key).select(columns))


def test_streamed_throughput_equals_the_batch_form(spark, in_order):
    path = batches(spark, in_order, lambda s, p, c: live.throughput_stream(s, p, c, 86_400, 60))
    columns = ["transaction_id", "throughput"]
    same(spark.read.parquet(f"{path}/out").select(columns), running.throughput(in_order[0], 86_400, 60).select(columns))
    carried = spark.read.parquet(f"{path}/carried")
    assert carried.groupBy("batch").count().agg(F.max("count"), F.count("*")).first()[:] == (60, 2)  # this batch and the one before


def test_streamed_newest_rows_equal_the_batch_form(spark, in_order):
    path = batches(spark, in_order, lambda s, p, c: live.recent_stream(s, p, c, ["user_id"], 4, buckets=8))
    got = live.newest(live.recent_table(spark, path, ["user_id"], in_order[0].schema, 8))
    same(got.select("user_id", "rank", "transaction_id"), running.recent_per_key(in_order[0], ["user_id"], 4).select("user_id", "rank", "transaction_id"))


def test_streamed_counters_equal_the_batch_form(spark, in_order):
    path = batches(spark, in_order, lambda s, p, c: live.counters_stream(s, p, c, 70))
    same(live.latest_counters(spark, path), running.running_counters(in_order[0], size=70).withColumn("batch", F.col("batch").cast("long")))


T0 = datetime(2024, 1, 1)


def test_a_metric_cache_agrees_with_a_dictionary(spark):
    cache, plain = MetricCache(spark, fresh(spark), buckets=4), {}
    history = []
    for b in range(5):
        now = T0 + timedelta(minutes=30 * b)
        steps = [(f"c{i % (3 + b)}", float(i), now) for i in range(20)]
        history.append((b, now, steps))
        for again in range(2):  # the second is a replay
            cache.increment(spark.createDataFrame(steps, "name string, value double, updated_at timestamp"), b, F.lit(now), 3600)
        plain = {n: v for n, v in plain.items() if v[1] > now}
        for n, v, _ in steps:
            plain[n] = (plain.get(n, (0.0,))[0] + v, now + timedelta(seconds=3600))
        got = {r["name"]: r["value"] for r in cache.read(F.lit(now)).collect()}
        assert got == {n: v for n, (v, end) in plain.items()}
    assert cache.read(F.lit(T0 + timedelta(days=1))).count() == 0


def test_set_keeps_the_newest_value_and_lets_old_ones_expire(spark):
    cache = MetricCache(spark, fresh(spark), buckets=2)
    put = lambda b, rows, now: cache.set(spark.createDataFrame(rows, "name string, value double, updated_at timestamp"), b, F.lit(now), 600)
    put(0, [("a", 1.0, T0), ("a", 2.0, T0 + timedelta(seconds=5)), ("b", 7.0, T0), (None, 3.0, T0)], T0)
    put(1, [("a", 9.0, T0 - timedelta(seconds=9))], T0)
    assert sorted(((r["name"] or "", r["value"]) for r in cache.read(F.lit(T0)).collect())) == [("", 3.0), ("a", 2.0), ("b", 7.0)]
    later = T0 + timedelta(seconds=700)
    put(2, [("d", 4.0, later)], later)
    assert [(r["name"], r["value"]) for r in cache.read(F.lit(later)).collect()] == [("d", 4.0)]


def test_untouched_buckets_keep_their_files_and_old_versions_go(spark):
    path = fresh(spark)
    table = KeyedTable(spark, path, ["k"], "k long, v long", buckets=8)
    files = lambda: {str(f.relative_to(path)) for f in Path(path).glob("bucket=*/batch=*/*.parquet")}
    sums = lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v"))
    table.merge(spark.range(50).selectExpr("id AS k", "1L AS v"), 0, sums)
    before = files()
    one = spark.createDataFrame([(7, 5)], "k long, v long")
    (bucket,) = table.touched(one)
    for b in range(1, 9):
        table.merge(one, b, sums)
    after = files()
    assert {f for f in before if not f.startswith(f"bucket={bucket}/")} == {f for f in after if not f.startswith(f"bucket={bucket}/")}
    assert {f.split("/")[1] for f in after if f.startswith(f"bucket={bucket}/")} == {"batch=7", "batch=8"}
    assert {r["k"]: r["v"] for r in table.read().collect()} == {**{k: 1 for k in range(50)}, 7: 41}
    table.merge(one, 8, sums)  # a replay
    assert {r["k"]: r["v"] for r in table.read().where("k = 7").collect()} == {7: 41}
    table.merge(one, 9, lambda rows: rows.where("false"))
    assert table.read(9).where("k = 7").count() == 1 and table.read().where("k = 7").count() == 0


def test_expired_days_of_alerts_are_deleted(spark):
    store = AlertStore(spark, fresh(spark), days=7)
    for day in (0, 3, 9, 20):
        store.append(spark.createDataFrame([(day, "x")], "transaction_id long, kind string"), F.lit(T0 + timedelta(days=day, hours=5)))
    assert sorted(p.name for p in Path(store.path).glob("created_day=*")) == ["created_day=2024-01-21"]
    assert store.expire(T0 + timedelta(days=27)) == [] and store.expire(T0 + timedelta(days=29)) == [date(2024, 1, 21)]


def test_a_backfill_replaces_its_days_only(spark, small):
    rows, path = transactions(spark, small, region=False), fresh(spark)
    first, last = rows.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    backfill(rows, path, first, last)
    files = lambda: {f.parent.name: f.name for f in sorted(Path(path).glob("day=*/*.parquet"))}
    content = lambda: sorted(map(str, spark.read.parquet(path).select("transaction_id", "risk_category", "day").collect()))
    before, want = files(), content()
    low, high = first + timedelta(days=2), first + timedelta(days=4)
    for _ in range(2):
        backfill(rows, path, low, high)
        assert content() == want
    after = files()
    inside = {f"day={low + timedelta(days=i)}" for i in range(3)}
    assert {d for d in before if before[d] != after.get(d)} == inside & set(before)
    backfill(rows.where(F.to_date("ts") != F.lit(low)), path, low, low)
    assert f"day={low}" not in files() and len(files()) == len(before) - 1


def test_a_failing_query_is_seen_while_another_runs(spark, in_order):
    table, source = in_order
    stream = spark.readStream.schema(table.schema).parquet(source)

    def broken(batch, batch_id):
        raise RuntimeError("broken sink")

    path = fresh(spark)
    endless = stream.writeStream.format("noop").option("checkpointLocation", f"{path}/a").trigger(processingTime="1 second").start()
    failing = stream.writeStream.foreachBatch(broken).option("checkpointLocation", f"{path}/b").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="broken sink"):
        sinks.finish(endless, failing)
    assert not endless.isActive


def test_a_query_killed_between_two_writes_leaves_the_same_tables(spark, in_order):
    table, source = in_order
    seen = defaultdict(int)

    def run(path, fail):
        def handle(batch, batch_id):
            batch.groupBy("user_id").count().write.mode("overwrite").parquet(f"{path}/users/batch={batch_id}")
            seen[path, batch_id] += 1
            if fail and batch_id in (1, 3) and seen[path, batch_id] == 1:
                raise RuntimeError("killed between two writes")
            cache = MetricCache(spark, f"{path}/cache", buckets=4)
            cache.increment(batch.select(F.col("channel").alias("name"), F.lit(1.0).alias("value"), F.col("ts").alias("updated_at")), batch_id, F.lit(T0), 10**9)

        def start():
            stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
            return stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()

        return lifecycle.supervised({"etl": start}, pause=0.0)

    calm, killed = fresh(spark), fresh(spark)
    assert run(calm, False) == {"etl": 0} and run(killed, True) == {"etl": 2}
    for name in ("users",):
        same(spark.read.parquet(f"{calm}/{name}").groupBy("user_id").agg(F.sum("count").alias("n")), spark.read.parquet(f"{killed}/{name}").groupBy("user_id").agg(F.sum("count").alias("n")))
    values = lambda p: {r["name"]: r["value"] for r in MetricCache(spark, f"{p}/cache", buckets=4).read(F.lit(T0)).collect()}
    assert values(calm) == values(killed) and sum(values(calm).values()) == table.count()


def test_a_stream_that_never_recovers_is_given_up(spark, in_order):
    table, source = in_order

    def broken(batch, batch_id):
        raise RuntimeError("always broken")

    path = fresh(spark)

    def start():
        stream = spark.readStream.schema(table.schema).parquet(source)
        return stream.writeStream.foreachBatch(broken).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()

    with pytest.raises(Exception, match="always broken"):
        lifecycle.supervised({"etl": start}, restarts=1, pause=0.0)


def test_totals_published_between_batches_reach_the_later_batch_only(spark):
    path, schema = fresh(spark), "user_id long, amount double"
    source = f"{path}/in"
    totals = VersionedTable(spark, f"{path}/totals")

    def publish(txns):
        return totals.publish(spark.createDataFrame([(1, txns)], "user_id long, user_txns long"))

    def run(value):
        spark.createDataFrame([(1, value), (2, value), (None, value)], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        sinks.finish(refreshed_join(stream, totals, ["user_id"], f"{path}/out", f"{path}/checkpoint"))

    def seen():
        rows = spark.read.parquet(f"{path}/out").collect()
        assert all(r["user_txns"] is None for r in rows if r["user_id"] != 1) and len({r["amount"] for r in rows}) * 3 == len(rows)
        return {r["amount"]: r["user_txns"] for r in rows if r["user_id"] == 1}

    publish(10)
    run(0.0)
    publish(20)
    run(1.0)
    publish(30)
    assert seen() == {0.0: 10, 1.0: 20}
    # The last batch is repeated, as after a crash before its commit: it reads the version it noted.
    commits = Path(f"{path}/checkpoint/commits".removeprefix("file:"))
    for commit in (commits / "1", commits / ".1.crc"):
        commit.unlink()
    run(2.0)
    assert seen() == {0.0: 10, 1.0: 20, 2.0: 30}


def test_published_versions_do_not_pile_up(spark):
    totals = VersionedTable(spark, fresh(spark))
    with pytest.raises(ValueError):
        totals.read("a", 0)
    for n in range(6):
        totals.publish(spark.createDataFrame([(n,)], "n long"))
        totals.read("a", n)
    assert totals.versions() == [3, 4, 5]
    assert totals.read("a", 4).first()["n"] == 4 and totals.read("a", 5).first()["n"] == 5
    totals.read("slow", 0)
    for n in range(6, 9):
        totals.publish(spark.createDataFrame([(n,)], "n long"))
        totals.read("a", n)
    assert totals.read("slow", 0).first()["n"] == 5
    totals.forget("slow")
    assert totals.publish(spark.createDataFrame([(9,)], "n long")) == 9 and totals.versions() == [7, 8, 9]
