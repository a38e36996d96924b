"""The perceptron's fit on packs: the windows, the gradient and the weights that MLlib finds, without a table of windows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.models import learn, perceptron
from riskweave.operators import features as f
from riskweave.plans.scoring import training_table
from riskweave.schemas import FEATURES
from riskweave.session import materialize


@pytest.fixture(scope="module")
def table(spark, small):
    return training_table(spark, small)


def scores(df):
    return {r["transaction_id"]: r["lstm"] for r in df.select("transaction_id", "lstm").collect()}


def unpacked(packs, width, columns):
    found = {}
    for r in packs.collect():
        starts, x = np.frombuffer(r["start"], np.int32), np.frombuffer(r["x"])
        for ident, s in zip(r["ids"], starts, strict=True):
            found[ident] = list(x[s * columns:s * columns + width])
    return found


@pytest.mark.parametrize("sizes, rows", [({}, 8192), ({"hot_rows": 50, "chunk_rows": 20, "block": 16}, 7)])
def test_packs_hold_the_windows_without_repeating_rows(table, sizes, rows, monkeypatch):
    monkeypatch.setattr(perceptron, "PACK_ROWS", rows)
    gaps = table.withColumn("risk", F.when(F.hash("transaction_id") % 5 != 0, F.col("transaction_amount")))
    names = ["transaction_amount", "risk"]
    want = {r[0]: [v or 0.0 for v in r[1]] for r in f.sequence_window(gaps, names).select("transaction_id", F.flatten("sequence")).collect()}
    packs = learn.sequence_packs(f.sequence_rows(gaps, names, **sizes), F.lit(True))
    assert unpacked(packs, 20, 2) == want and len(want) > 300
    if not sizes:  # a window table would hold ten numbers for each of these
        assert sum(len(r["x"]) for r in packs.select("x").collect()) == 8 * 2 * table.count()


def test_gradient_is_that_of_the_loss_over_all_learned_windows(table):
    packs = learn.sequence_packs(f.sequence_rows(table, keep=["split", "validation"]), F.col("split") == "train", "validation")
    layers, columns = [120, 6, 4, 2], len(FEATURES)
    mean, scale = perceptron.moments(packs, 120, columns)
    rows = f.sequence_window(table, keep=["split", "validation"]).where("split = 'train' AND NOT validation")
    got = rows.select(F.flatten("sequence"), F.col("is_fraud").cast("int")).collect()
    x, y = np.array([r[0] for r in got]), np.array([r[1] for r in got])
    assert mean == pytest.approx(x.mean(axis=0)) and scale[x.std(axis=0) > 0] == pytest.approx(1 / x.std(axis=0, ddof=1)[x.std(axis=0) > 0])
    z, rng = (x - mean) * scale, np.random.default_rng(1)
    weights = rng.normal(0, 0.3, sum(a * b + b for a, b in zip(layers, layers[1:])))

    def plain(w):
        p = perceptron._probability(z, perceptron._split(w, layers))
        return -np.log(np.where(y == 1, p, 1 - p)).mean()

    loss, gradient = perceptron.loss_and_gradient(packs, layers, columns, weights, perceptron.Scaling(columns, mean, scale))
    assert loss == pytest.approx(plain(weights), rel=1e-6)
    for i in rng.choice(len(weights), 25, replace=False):
        step = np.eye(1, len(weights), i)[0] * 1e-5
        assert gradient[i] == pytest.approx((plain(weights + step) - plain(weights - step)) / 2e-5, rel=1e-3, abs=1e-6)


def test_weights_lead_where_those_of_mllib_do(table):
    """After few rounds, before the rows' order in blocks, which counts in MLlib's mean of block means, shows."""
    sequences = materialize(f.sequence_window(table))
    rows = learn.sequence_features(sequences).withColumn("label", F.col("is_fraud").cast("double"))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    net = MultilayerPerceptronClassifier(layers=[120, 64, 32, 2], featuresCol="scaled", labelCol="label", maxIter=4, seed=42)
    made = Pipeline(stages=[scaler, net]).fit(rows).transform(rows).withColumn("lstm", vector_to_array("probability")[1])
    packs = learn.sequence_packs(f.sequence_rows(table), F.lit(True))
    ours = learn.fit_sequence_packs(packs, rounds=4)
    want, got = scores(made), scores(learn.sequence_pack_scores(ours, packs))
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 0.02
    assert got == pytest.approx(scores(learn.sequence_scores(ours, sequences)), abs=1e-9)
    assert got == pytest.approx(scores(learn.sequence_scores(learn.fit_sequence(sequences, rounds=4), sequences)), abs=1e-3)


def test_rows_without_label_are_scored_and_not_learned_from(table):
    some = table.withColumn("is_fraud", F.when(F.col("split") == "train", F.col("is_fraud")))
    packs = learn.sequence_packs(f.sequence_rows(some, keep=["split"]), F.lit(True))
    rest = learn.sequence_packs(f.sequence_rows(table, keep=["split"]), F.col("split") == "train")
    one, other = (learn.fit_sequence_packs(p, rounds=2) for p in (packs, rest))
    assert len(scores(learn.sequence_pack_scores(one, packs))) == f.sequence_window(table).count()
    assert one.stages[-1].weights.toArray() == pytest.approx(other.stages[-1].weights.toArray(), abs=1e-4)


def test_descent_finds_the_lowest_point():
    a = np.diag([1.0, 10.0, 100.0])
    found = perceptron.descend(lambda x: (0.5 * x @ a @ x + 1.0, a @ x), np.array([3.0, -2.0, 1.0]), 30)
    assert found == pytest.approx([0, 0, 0], abs=2e-3)
    assert perceptron.descend(lambda x: (np.nan, x * np.nan), np.ones(3), 5) == pytest.approx(np.ones(3))
