"""Features of a stream from bounded history equal those of the whole table, whatever its age."""

import random
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.operators.features import transaction_features
from riskweave.schemas import FEATURES
from riskweave.session import shared_dir
from riskweave.streaming.history import LEVELS, BoundedHistory
from riskweave.streaming.jobs import batch_features

SCHEMA = ("transaction_id long, user_id long, ts timestamp, amount double, channel string, merchant string, region string, "
          "latitude double, longitude double, device_id string, is_fraud boolean")
T0 = datetime(2024, 1, 1)


def rows(n, days, seed=1):
    """`n` transactions in event order over `days`; one user owns a third, devices and positions vary, some are missing."""
    rng = random.Random(seed)
    times = sorted(rng.uniform(0, days * 86_400) for _ in range(n))
    out = []
    for i, t in enumerate(times):
        user = 1 if rng.random() < 0.34 else rng.randint(2, 12)
        place = (None, None) if rng.random() < 0.05 else (rng.choice([10.0, 10.5, 40.25]), rng.choice([-3.0, 2.5]))
        out.append((i, user, T0 + timedelta(seconds=round(t)), rng.randint(1, 90_000) / 100, rng.choice(["web", "pos"]), f"m{rng.randint(0, 3)}",
                    rng.choice(["US", "EU", None]), *place, rng.choice([None, f"d{user}", f"d{user}b", "shared"]), rng.random() < 0.2))
    return out


def table(df):
    return {r["transaction_id"]: [round(r[n], 9) if r[n] is not None else None for n in FEATURES] for r in df.collect()}


def run(spark, given, size, history, replay=()):
    got = {}
    for b in range(-(-len(given) // size)):
        batch = spark.createDataFrame(given[b * size : (b + 1) * size], SCHEMA)
        for _ in range(2 if b in replay else 1):
            made = table(batch_features(batch, b, history))
            history.append(batch, b)
        got |= made
    return got


def test_features_equal_those_of_the_whole_table(spark):
    given, size = rows(200, 140), 40
    history = BoundedHistory(f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", buckets=2, fan=2)
    got = run(spark, given, size, history, replay=(3,))
    want = table(transaction_features(spark.createDataFrame(given, SCHEMA)))
    assert got == want
    # Rows older than the look-back have become summaries, and their folders are gone.
    runs = history.runs_before(spark, len(given) // size)
    days = sorted(p.name for r in runs for p in Path(r).glob("day=*"))
    assert days[0] >= f"day={(given[-size - 1][2] - timedelta(days=32)).date()}"
    assert sum(r["n"] for r in spark.read.parquet(*sorted(str(p) for p in Path(history.path).glob("users/bucket=*/batch=*"))).collect()) > 100


def test_folders_do_not_grow_with_the_batches(spark):
    history = BoundedHistory(f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", buckets=2, fan=2)
    given, most = rows(20, 20), []
    for b in range(10):
        history.append(spark.createDataFrame(given[2 * b : 2 * b + 2], SCHEMA), b)
        runs = history.runs_before(spark, b + 1)
        most.append(len(runs))
        kept = spark.read.option("basePath", f"{history.path}/rows").parquet(*runs)
        assert sorted(r[0] for r in kept.select("transaction_id").collect()) == list(range(2 * b + 2))
    assert max(most) <= 2 * LEVELS  # fan - 1 open runs a level


def test_a_late_row_sees_the_summaries_and_counts_once(spark):
    history = BoundedHistory(f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", buckets=2)
    one = lambda i, day: (i, 7, T0 + timedelta(days=day), 10.0, "web", "m", "US", 10.0, 20.0, "d7", False)
    for b, day in enumerate((0, 100, 5, 200)):
        history.append(spark.createDataFrame([one(b, day)], SCHEMA), b)
    batch = spark.createDataFrame([one(9, 201)], SCHEMA)
    past = history.rows_before(batch, 4)
    assert past.agg(F.sum(F.coalesce("_weight", F.lit(1)))).first()[0] == 4
    made = batch_features(batch, 4, history).first()
    assert made["device_fingerprint_match"] == 0.0 and made["geo_anomaly_score"] == 0.0


def test_sequences_are_refused(spark):
    history = BoundedHistory(f"{shared_dir(spark)}/history-{uuid.uuid4().hex}")
    with pytest.raises(ValueError):
        batch_features(spark.createDataFrame(rows(3, 1), SCHEMA), 0, history, sequences=True)
    with pytest.raises(ValueError):
        BoundedHistory("x", days=7)
