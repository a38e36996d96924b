"""Behaviour features against a short plain-Python model, with ties and limits."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.operators import features as f, running as r

START = datetime(2024, 1, 1)
SCHEMA = ("transaction_id long, user_id long, ts timestamp, amount double, channel string, merchant string, region string, "
          "latitude double, longitude double, device_id string, is_fraud boolean, risk_score int, processing_ms int, status string")
GAPS = [0, 60, 3599, 3600, 3601, 86400, 86401, 30 * 86400, 5 * 86400, 600]


def make(rng, n):
    clock, rows = {}, []
    for i in range(n):
        user = rng.choice([1, 1, 1, 2, 3])
        clock[user] = clock.get(user, 0) + rng.choice(GAPS)
        rows.append((
            i, user, START + timedelta(seconds=clock[user]), rng.choice([0.0, 10.0, 250.5, 900.0, 1200.0]),
            rng.choice(["WEB", "ATM"]), rng.choice(["A", "B"]), rng.choice(["APAC", "EU-WEST"]),
            float(rng.randint(-80, 80)), float(rng.randint(-180, 180)), rng.choice(["d1", "d2", "d3"]),
            rng.random() < 0.4, rng.randint(0, 99), rng.randint(8, 127), "FLAGGED"))
    return rows


def model(rows):
    """The 12 features, straight from their definitions."""
    out = {}
    for row in rows:
        i, user, ts, amount, channel, merchant, region, lat, lng, device, *_ = row
        past = sorted((p for p in rows if p[1] == user and (p[2], p[0]) < (ts, i)), key=lambda p: (p[2], p[0]))
        month = [p for p in past if p[2] >= ts - timedelta(days=30)]
        shop = [p[10] for p in rows if p[5] == merchant and p[2].date() < ts.date()]
        far = 0.0
        if past:
            mid = [sum(p[k] for p in past) / len(past) for k in (7, 8)]
            far = min(1.0, ((lat - mid[0]) ** 2 + (lng - mid[1]) ** 2) ** 0.5 / 50)
        mean = sum(p[3] for p in month) / len(month) if month else 0
        out[i] = [
            amount, sum(p[2] > ts - timedelta(hours=1) for p in past), sum(shop) / len(shop) if shop else 0.5, far,
            0.0 if any(p[9] == device for p in past) else 0.8,
            min(1.0, (ts - past[-1][2]).total_seconds() / 86400) if past else 1.0,
            0.0 if len(month) < 5 or mean == 0 else min(1.0, abs(amount - mean) / mean),
            sum(p[4] == channel for p in month) / len(month) if month else 0.0,
            ts.hour, ts.weekday(), amount > 500, region == "APAC"]
    return out


@pytest.mark.parametrize("seed,sizes", [(1, {}), (2, {"hot_rows": 10, "chunk_rows": 6}), (3, {"hot_rows": 3, "chunk_rows": 2})])
def test_feature_vector(spark, seed, sizes):
    rows = make(random.Random(seed), 70)
    got = f.transaction_features(spark.createDataFrame(rows, SCHEMA), **sizes).collect()
    want = model(rows)
    assert len(got) == len(rows)
    for r_ in got:
        assert list(r_)[1:] == pytest.approx([float(x) for x in want[r_["transaction_id"]]]), r_


def test_regions_may_come_from_a_lookup(spark):
    df = spark.createDataFrame(make(random.Random(2), 60), SCHEMA).withColumn("region", F.when(F.col("user_id") == 1, "APAC").otherwise("EU-WEST"))
    lookup = df.select("user_id", "region").distinct().where("user_id < 3")
    direct = {r_["transaction_id"]: tuple(r_) for r_ in f.transaction_features(df).collect()}
    looked_up = {r_["transaction_id"]: tuple(r_) for r_ in f.transaction_features(df.drop("region"), regions=lookup).collect()}
    assert direct == looked_up


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 5, "chunk_rows": 4}])
def test_other_history_features(spark, sizes):
    rows = make(random.Random(11), 60)
    df = spark.createDataFrame(rows, SCHEMA)

    def by_id(frame, name):
        return {x["transaction_id"]: x[name] for x in frame.collect()}

    second = by_id(f.time_since_second_last(df, **sizes), "time_since_prev2_1h")
    moves = by_id(f.change_rate(df, "merchant", "rate", **sizes), "rate")
    kinds = by_id(f.channel_diversity(df, **sizes), "channel_diversity")
    ratio = by_id(f.amount_ratio(df, **sizes), "amount_ratio_30d")
    for row in rows:
        i, user, ts = row[:3]
        past = sorted((p for p in rows if p[1] == user and (p[2], p[0]) < (ts, i)), key=lambda p: (p[2], p[0]))
        hour = [p for p in past if p[2] > ts - timedelta(hours=1)]
        assert second[i] == pytest.approx((ts - hour[-2][2]).total_seconds() / 86400 if len(hour) >= 2 else 1.0)
        line = [p[5] for p in past] + [row[5]]
        steps = [a != b for a, b in zip(line, line[1:])]
        assert moves[i] == pytest.approx(sum(steps) / len(steps) if steps else 0.0)
        assert kinds[i] == len({p[4] for p in past} | {row[4]})
        month = [p[3] for p in past if p[2] >= ts - timedelta(days=30)]
        mean = sum(month) / len(month) if month else 0
        assert ratio[i] == (pytest.approx(row[3] / mean) if mean else None)


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 5, "chunk_rows": 4, "block": 12}])
def test_sequences(spark, sizes):
    rows = make(random.Random(5), 80)
    got = {r_["transaction_id"]: r_ for r_ in f.sequence_window(spark.createDataFrame(rows, SCHEMA), ["amount", "latitude"], **sizes).collect()}
    for row in rows:
        past = sorted((p for p in rows if p[1] == row[1] and (p[2], p[0]) < (row[2], row[0])), key=lambda p: (p[2], p[0]))
        if len(past) < 10:
            assert row[0] not in got
        else:
            assert got[row[0]]["sequence"] == [[p[3], p[7]] for p in past[-10:]]
            assert got[row[0]]["is_fraud"] == row[10]


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 10, "chunk_rows": 7}])
def test_trailing_metrics(spark, sizes):
    rows = make(random.Random(9), 120)
    df = spark.createDataFrame(rows, SCHEMA)
    line = sorted(rows, key=lambda p: (p[2], p[0]))
    block = {"block": 32} if sizes else {}
    mean = {x["transaction_id"]: x["avg_latency_ms"] for x in r.trailing_latency(df, 20, **block, **sizes).collect()}
    rate = {x["transaction_id"]: x["throughput"] for x in r.throughput(df, 60, 5, **sizes).collect()}
    for k, row in enumerate(line):
        last = [p[12] for p in line[max(0, k - 19): k + 1]]
        assert mean[row[0]] == pytest.approx(sum(last) / len(last))
        near = [p for p in line[: k + 1] if p[2] >= row[2] - timedelta(seconds=60)]
        assert rate[row[0]] == min(5, len(near))


def test_batches_keep_their_tail(spark):
    rows = make(random.Random(4), 205)
    df = spark.createDataFrame(rows, SCHEMA)
    for sizes in ({}, {"hot_rows": 1, "chunk_rows": 1}):
        out = r.running_counters(df, **sizes).orderBy("batch").collect()
        assert [x["total_count"] for x in out] == [100, 200, 205]
        assert out[-1]["fraud_count"] == sum(p[10] for p in rows)
        assert out[-1]["running_avg_risk"] == pytest.approx(sum(p[11] for p in rows) / 205)


def test_device_reuse(spark):
    df = spark.createDataFrame(make(random.Random(8), 50), SCHEMA)
    want = {d: n for d, n in df.groupBy("device_id").agg(F.count_distinct("user_id")).collect()}
    assert all(x["device_users"] == want[x["device_id"]] for x in f.device_reuse(df).collect())


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 4, "chunk_rows": 3}])
def test_users_of_a_device_before_the_row(spark, sizes):
    rng = random.Random(18)
    rows = [(i, rng.choice([1, 2, 3, 4, None]), START + timedelta(hours=rng.randint(0, 9)), rng.choice(["hot", "hot", "d", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "transaction_id long, user_id long, ts timestamp, device_id string")
    got = {x["transaction_id"]: x["device_users_before"] for x in f.users_before(df, **sizes).collect()}
    want = {i: None if d is None else len({p[1] for p in rows if p[3] == d and (p[2], p[0]) < (ts, i)}) for i, _, ts, d in rows}
    assert got == want
    assert f.users_before(df.where("false"), **sizes).collect() == []
