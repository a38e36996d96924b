"""Balanced running totals against brute force, with ties, gaps on the limit and forced chunks."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from riskweave.functions.columns import DAY, HOUR
from riskweave.functions import history
from riskweave.functions.history import Measure, before, with_blocks
from riskweave.functions.stats import exact_percentiles, exact_percentiles_of, sketch_percentiles, sketched

SCHEMA = "user int, t long, id int, kind string, amount long"
GAPS = [0, 0, 1, HOUR - 1, HOUR, HOUR + 1, 24 * HOUR, 30 * DAY - 1, 30 * DAY, 30 * DAY + 1, 17 * HOUR]


def make_rows(rng, n, users=3):
    rows, clock = [], {}
    for i in range(n):
        user = rng.choice([0] * 5 + list(range(users)))
        clock[user] = clock.get(user, 0) + rng.choice(GAPS)
        rows.append((user, clock[user], i, rng.choice("abc"), rng.randint(-5, 50)))
    return rows


def measures():
    return [
        Measure("n", F.lit(1)),
        Measure("hour", F.lit(1), HOUR),
        Measure("month", F.col("amount"), 30 * DAY, True),
        Measure("kind_month", F.lit(1), 30 * DAY, True, ("kind",)),
        Measure("kind_ever", F.lit(1), per=("kind",)),
        Measure("last_t", F.col("t"), how="max"),
        Measure("last_kind", F.col("kind"), how="last"),
    ]


def brute(rows):
    out = {}
    for user, t, i, kind, _ in rows:
        past = sorted((r for r in rows if r[0] == user and (r[1], r[2]) < (t, i)), key=lambda r: (r[1], r[2]))
        month = [r for r in past if r[1] >= t - 30 * DAY]
        out[i] = (
            len(past),
            sum(1 for r in past if r[1] > t - HOUR),
            sum(r[4] for r in month),
            sum(1 for r in month if r[3] == kind),
            sum(1 for r in past if r[3] == kind),
            past[-1][1] if past else None,
            past[-1][3] if past else None,
        )
    return out


def run(spark, rows, **sizes):
    df = before(spark.createDataFrame(rows, SCHEMA), ["user"], "t", "id", measures(), **sizes)
    names = [m.name for m in measures()]
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 3, "chunk_rows": 2}, {"hot_rows": 10, "chunk_rows": 5}])
def test_before_matches_brute_force(spark, sizes):
    rows = make_rows(random.Random(7), 160)
    assert run(spark, rows, **sizes) == brute(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10**6), n=st.integers(1, 40), chunk=st.integers(1, 9))
def test_before_for_any_history_and_chunk(spark, seed, n, chunk):
    rows = make_rows(random.Random(seed), n)
    assert run(spark, rows, hot_rows=2, chunk_rows=chunk) == brute(rows)


def test_rows_at_one_single_time_stay_exact(spark):
    rows = [(1, 5, i, "a", 1) for i in range(30)]
    assert run(spark, rows, hot_rows=3, chunk_rows=2) == brute(rows)


def test_null_key_is_a_key_of_its_own(spark):
    rows = [(None, i, i, "a", 1) for i in range(9)] + [(1, i, 100 + i, "a", 1) for i in range(9)]
    got = run(spark, rows, hot_rows=4, chunk_rows=2)
    assert got == brute(rows)


HARD_TIMES = {
    "a third of the rows": lambda i: float(i),
    "one outlier": lambda i: 1e12 if i == 7 else i / 1000,
    "one single time": lambda i: 5.0,
    "infinite ends": lambda i: float("inf") if i % 3 == 0 else float("-inf") if i % 3 == 1 else float(i),
    "log-normal": lambda i: float(np.exp(4 * np.sin(i * i))),
}


@pytest.mark.parametrize("kind", HARD_TIMES)
def test_no_chunk_of_a_hot_key_is_much_larger_than_asked(spark, kind, monkeypatch):
    rows = [(0, HARD_TIMES[kind](i), i) for i in range(3000)] + [(1 + i, float(i), 5000 + i) for i in range(3000)]
    df = spark.createDataFrame(rows, "user int, t double, id int")
    written = []
    keep = history.materialize
    monkeypatch.setattr(history, "materialize", lambda x: written.append(keep(x)) or written[-1])
    out = before(df, ["user"], "t", "id", [Measure("n", F.lit(1))], hot_rows=500, chunk_rows=100)
    sizes = [r["count"] for r in written[0].groupBy("user", "_chunk").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 200
    order = {i: n for n, (_, _, i) in enumerate(sorted(r for r in rows if r[0] == 0))}
    assert {r["id"]: r["n"] for r in out.where("user = 0").collect()} == order


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 3, "chunk_rows": 2}])
def test_a_row_without_a_time_has_and_gives_nothing(spark, sizes):
    rows = make_rows(random.Random(5), 60)
    timeless = [(0, None, 1000, "a", 7), (0, None, 1001, "b", 7)]
    got = run(spark, rows + timeless, **sizes)
    assert {i: v for i, v in got.items() if i < 1000} == brute(rows)
    assert got[1000] == got[1001] == (None,) * len(measures())


@pytest.mark.parametrize("frame, block", [(10, 5), (64, 5), (3, 64), (5, 5)])
def test_frames_longer_than_a_block_stay_whole(spark, frame, block):
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("p"))
    w = Window.partitionBy("k", "_block").orderBy("p").rowsBetween(-frame, 0)
    got = with_blocks(df, ["k"], "p", frame, block).withColumn("s", F.sum("p").over(w)).where("NOT _lead_in").select("p", "s").collect()
    assert len(got) == 200 and all(r["s"] == sum(range(max(0, r["p"] - frame), r["p"] + 1)) for r in got)


def test_blocks_hold_few_rows_and_frames_stay_whole(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("p"))
    blocks = with_blocks(df, ["k"], "p", 10, block=64)
    assert blocks.groupBy("_block").count().agg(F.max("count")).first()[0] <= 74
    w = Window.partitionBy("k", "_block").orderBy("p").rowsBetween(-10, -1)
    got = blocks.withColumn("s", F.sum("p").over(w)).where("NOT _lead_in").select("p", "s").collect()
    assert len(got) == 1000
    assert all((r["s"] or 0) == sum(range(max(0, r["p"] - 10), r["p"])) for r in got)


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 20, "chunk_rows": 7}])
def test_percentiles_equal_numpy(spark, sizes):
    rng = np.random.default_rng(3)
    values = {g: np.round(rng.lognormal(3, 2, size=200 + g), 2) for g in range(3)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [(0, None)], "g int, x double")
    out = {r["g"]: r for r in exact_percentiles(df, "x", {"p0": 0, "p50": 0.5, "p95": 0.95, "p100": 1}, ["g"], **sizes).collect()}
    for g, vs in values.items():
        want = np.quantile(vs, [0, 0.5, 0.95, 1])
        assert [out[g][n] for n in ("p0", "p50", "p95", "p100")] == pytest.approx(want)
    many = np.round(rng.lognormal(3, 2, size=30_000), 1)
    large = spark.createDataFrame([(float(v),) for v in [*many, float("nan")]], "x double").repartition(5)
    assert exact_percentiles(large, "x", {"a": 0.25, "b": 0.999}, **sizes).first()[:] == pytest.approx(tuple(np.quantile(many, [0.25, 0.999])))
    whole = exact_percentiles(df, "x", {"p": 0.9}, **sizes).first()["p"]
    assert whole == pytest.approx(np.quantile(np.concatenate(list(values.values())), 0.9))


def test_percentiles_of_many_columns_in_wide_form(spark):
    """Brackets narrower than the table, ties, gaps, a constant, few values and none."""
    n, probs = 30_000, {"p1": 0.01, "p50": 0.5, "p999": 0.999}
    rng = np.random.default_rng(3)
    columns = [rng.normal(0, 1, n), np.floor(rng.exponential(3, n)), np.full(n, 7.0), rng.normal(0, 1, n), np.full(n, np.nan)]
    columns[3][50:] = np.nan
    names = list("abcde")
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in row) for i, row in enumerate(zip(*columns))], "a double, b double, c double, d double, e double")
    out = {r["metric"]: r for r in exact_percentiles_of(df, names, probs, {"high": F.max}, hot_rows=40, chunk_rows=20).collect()}
    for name, x in zip(names, columns):
        x = x[~np.isnan(x)]
        assert out[name]["count"] == len(x)
        want = np.quantile(x, list(probs.values())) if len(x) else [None] * 3
        assert [out[name][p] for p in probs] == pytest.approx(list(want)) and out[name]["high"] == (x.max() if len(x) else None)
    assert exact_percentiles(df.where("false"), "a", {"p": 0.5}).collect() == [(None,)]


def test_merged_sketches_stay_within_their_error(spark):
    rows = spark.range(200_000).select((F.col("id") % 97).alias("part"), (F.pmod(F.hash("id"), F.lit(1_000_003)) / 7.0).alias("x"), (F.col("id") % 2).alias("g"))
    sketches = rows.groupBy("g", "part").agg(sketched("x").alias("sketch"))
    for r in sketch_percentiles(sketches, {"p50": 0.5, "p99": 0.99}, ["g"]).collect():
        of_group = rows.where(F.col("g") == r["g"])
        for name, p in (("p50", 0.5), ("p99", 0.99)):
            assert abs(of_group.where(F.col("x") <= r[name]).count() / of_group.count() - p) < 0.003
    small = rows.where("g = 0 AND part < 2")
    values = np.sort([r["x"] for r in small.collect()])
    exact = sketch_percentiles(small.groupBy("part").agg(sketched("x").alias("sketch")), {"p": 0.25}).first()["p"]
    assert len(values) <= 4096 and exact == values[int(np.ceil(0.25 * len(values))) - 1]
