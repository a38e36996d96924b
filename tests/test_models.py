"""Models: invariants of the fits, exact checks of the arithmetic around them."""

import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.models import ensemble as e, evaluate as v, learn
from riskweave.models.forest import IsolationForest, expected_length
from riskweave.operators import features as f
from riskweave.schemas import FEATURES, GEO_CROSS_BORDER
from riskweave.session import materialize
from riskweave.sources.tables import payments, transactions


@pytest.fixture(scope="module")
def table(spark, small):
    rows = f.transaction_features(transactions(spark, small), cross_border=GEO_CROSS_BORDER, keep=["is_fraud", "user_id", "ts", "risk_score"])
    return materialize(learn.stratified_split(rows))


def test_split_is_complete_disjoint_and_stable(spark, table):
    parts = {s: {r[0] for r in table.where(F.col("split") == s).select("transaction_id").collect()} for s in ("train", "test")}
    assert not parts["train"] & parts["test"]
    assert len(parts["train"]) + len(parts["test"]) == table.count()
    again = learn.stratified_split(table.drop("split").repartition(5)).where("split = 'test'")
    assert {r[0] for r in again.select("transaction_id").collect()} == parts["test"]
    shares = table.groupBy("is_fraud").agg(F.avg((F.col("split") == "test").cast("int"))).collect()
    assert all(abs(share - 0.2) < 0.07 for _, share in shares)


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    normal, odd = rng.normal(0, 1, (600, 3)), rng.normal(9, 1, (12, 3))
    rows = [(i, *map(float, x), i >= 600) for i, x in enumerate(np.vstack([normal, odd]))]
    return spark.createDataFrame(rows, "transaction_id long, a double, b double, c double, odd boolean")


@pytest.fixture(scope="module")
def forest(planted):
    return IsolationForest.fit(planted, ["a", "b", "c"], trees=50, contamination=0.02)


def test_forest_ranks_outliers_first(planted, forest):
    scored = forest.transform(planted).toPandas()
    assert scored[scored.odd].anomaly_score.min() > scored[~scored.odd].anomaly_score.quantile(0.97)
    assert scored.isolation_forest.between(0, 1).all()
    assert 6 <= scored.anomaly.sum() <= 20
    assert v.auc_roc(forest.transform(planted), "odd", "anomaly_score").first()["auc"] > 0.99


def test_forest_scores_do_not_depend_on_the_batch(planted, forest):
    whole = {r["transaction_id"]: r["isolation_forest"] for r in forest.transform(planted).collect()}
    alone = forest.transform(planted.where("transaction_id = 605")).first()
    assert alone["isolation_forest"] == whole[605]
    spread = forest.transform(planted.repartition(8)).collect()
    assert {r["transaction_id"]: r["isolation_forest"] for r in spread} == whole


def test_forest_scored_once_gives_what_fit_and_transform_give(planted):
    train = F.col("transaction_id") % 4 != 0
    names = ["a", "b", "c"]
    apart = IsolationForest.fit(planted.where(train), names, trees=20).transform(planted)
    model, scored = IsolationForest.fit_transform(planted, names, train=train, trees=20)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, apart.collect()))
    assert model.low < model.limit < model.high


def test_forest_fit_is_repeatable_and_saved(spark, planted, forest, tmp_path):
    again = IsolationForest.fit(planted.repartition(7), ["a", "b", "c"], trees=50, contamination=0.02)
    np.testing.assert_array_equal(again.threshold, forest.threshold)
    forest.save(spark, str(tmp_path / "forest"))
    loaded = IsolationForest.load(spark, str(tmp_path / "forest"))
    for name in ("feature", "threshold", "length"):
        np.testing.assert_array_equal(getattr(loaded, name), getattr(forest, name))
    assert (loaded.limit, loaded.low, loaded.high, loaded.features) == (forest.limit, forest.low, forest.high, forest.features)
    assert forest.importance() == {n: pytest.approx(1 / 3) for n in "abc"}


def test_forest_draws_full_samples(planted):
    from riskweave.models.forest import draw_rows

    sizes = draw_rows(planted, planted.count(), ["a"], "transaction_id", 40, 64, 1).groupBy("tree").agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("d")).collect()
    assert len(sizes) == 40 and all(r["n"] == r["d"] == 64 for r in sizes)


def test_expected_length():
    assert expected_length(1) == 0 and expected_length(2) == 1
    assert expected_length(256) == pytest.approx(10.244, abs=1e-2)


def test_boosted_trees_learn_and_reload(spark, table, tmp_path):
    rows = table.withColumn("risk_score", F.col("risk_score").cast("double"))
    names = [*FEATURES, "risk_score"]
    model = learn.fit_boosted(rows.where("split = 'train'"), names, rounds=8, depth=4, positive_weight=None)
    scored = learn.boosted_scores(model, rows.where("split = 'test'"))
    assert v.auc_roc(scored, "is_fraud", "xgboost").first()["auc"] > 0.8
    assert scored.agg(F.min("xgboost"), F.max("xgboost")).first()[0] >= 0
    weights = learn.feature_importance(spark, names, model).collect()
    assert weights[0]["feature"] == "risk_score" and sum(r["importance"] for r in weights) == pytest.approx(1.0)
    assert {r["importance"] for r in learn.feature_importance(spark).collect()} == {1 / 12}
    model.write().overwrite().save(str(tmp_path / "boosted"))
    again = learn.boosted_scores(PipelineModel.load(str(tmp_path / "boosted")), rows.where("split = 'test'"))
    assert again.agg(F.sum("xgboost")).first()[0] == pytest.approx(scored.agg(F.sum("xgboost")).first()[0])


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (900, 5))
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 1, 900) > 0.8
    rows = [(i, *map(float, r), bool(t), i % 3 == 0) for i, (r, t) in enumerate(zip(x, y))]
    return materialize(spark.createDataFrame(rows, "transaction_id long, a double, b double, c double, d double, e double, is_fraud boolean, held boolean"))


def test_boosted_trees_stop_where_a_replay_of_the_stages_does(labelled):
    names, patience = list("abcde"), 3
    settings = dict(rounds=15, depth=3, step=0.6, validation="held", positive_weight=1.0)
    every = learn.fit_boosted(labelled, names, patience=99, **settings).stages[-1]
    stopped = learn.fit_boosted(labelled, names, patience=patience, **settings).stages[-1]
    # With a patience beyond the rounds the best round of all is kept, so the replay begins with its trees.
    held = labelled.where("held").toPandas()
    rows = learn.feature_matrix(labelled.where("held"), names)
    margins, stages, aucs, best = np.zeros(len(held)), [], [], 0
    for number, tree in enumerate(every.trees):
        steps = {r["transaction_id"]: r["prediction"] for r in tree.transform(rows).select("transaction_id", "prediction").collect()}
        margins = margins + 0.6 * np.array([steps[i] for i in held.transaction_id])
        stages.append(margins)
        bins = np.floor(learn.AUC_BINS / (1 + np.exp(-margins)))
        apart = np.sign(bins[held.is_fraud.to_numpy()][:, None] - bins[~held.is_fraud.to_numpy()][None, :])
        aucs.append(((apart + 1) / 2).mean())
        best = number if aucs[number] > aucs[best] else best
        if number - best >= patience:
            break
    assert max(aucs) > 0.75 and aucs[-1] > 0.5
    assert stopped.getNumTrees == best + 1
    kept = {r["transaction_id"]: r["p"] for r in stopped.transform(rows).select("transaction_id", vector_to_array("probability")[1].alias("p")).collect()}
    # Sums over rows in another order may differ in their last digits.
    assert [kept[i] for i in held.transaction_id] == pytest.approx(list(1 / (1 + np.exp(-stages[best]))), abs=1e-6)


def test_each_boosted_tree_sees_its_own_draw_of_columns(labelled):
    trees = learn.fit_boosted(labelled, list("abcde"), rounds=12, depth=4, colsample=0.4).stages[-1].trees
    used = [{int(w) for w in re.findall(r"feature (\d+)", t.toDebugString)} for t in trees]
    assert len(trees) == 12 and all(len(u) <= 2 for u in used) and len(set.union(*used)) == 5


def test_boosted_leaves_are_newton_steps(labelled):
    """One tree without a split: its leaf is the sum of y - p over the sum of p(1 - p), by weight."""
    constant = labelled.withColumn("a", F.lit(1.0))
    model = learn.fit_boosted(constant, ["a"], rounds=1, step=1.0, subsample=1.0, positive_weight=3.0)
    yes, no = (labelled.where(w).count() for w in ("is_fraud", "NOT is_fraud"))
    leaf = (3 * yes * 0.5 - no * 0.5) / ((3 * yes + no) * 0.25)
    assert learn.boosted_scores(model, constant).first()["xgboost"] == pytest.approx(1 / (1 + np.exp(-leaf)))


def test_the_best_round_counts_only_within_the_patience():
    assert learn.stop_round([0.5, 0.7, 0.6, 0.6, 0.9], 2) == (1, True)
    assert learn.stop_round([0.5, 0.7, 0.6, 0.8], 3) == (3, False)
    assert learn.stop_round([0.5, 0.5], 1) == (0, True)


def test_sequence_model(table):
    sequences = f.sequence_window(table)
    scored = learn.sequence_scores(learn.fit_sequence(sequences, rounds=5), sequences)
    low, high = scored.agg(F.min("lstm"), F.max("lstm")).first()
    assert 0 <= low <= high <= 1


def test_pca_shares_match_numpy(table):
    names = ["transaction_amount", "geo_anomaly_score", "channel_frequency_score", "hour_of_day"]
    model = learn.fit_pca(table, names)
    x = table.select(*names).toPandas().to_numpy()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values = np.linalg.eigvalsh(np.cov(z.T))[::-1]
    assert model.stages[-1].explainedVariance.toArray() == pytest.approx((values / values.sum())[:2])
    assert learn.pca_2d(model, table).select("pc1", "pc2").na.drop().count() == table.count()


def test_payment_matrix_has_no_gap(spark, small):
    rows = learn.feature_matrix(learn.payment_features(payments(spark, small)), learn.PAYMENT_FEATURES)
    assert rows.first()["features"].size == 15
    assert rows.select(*learn.PAYMENT_FEATURES).na.drop().count() == rows.count() == 6000


def score_frame(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, isolation_forest double, xgboost double, lstm double")


def test_ensemble_renormalises_or_not(spark):
    df = score_frame(spark, [("a", 0.8, 0.9, 0.7), ("b", 0.8, 0.9, None), ("c", 1.0, 1.0, 1.0), (None, None, None, None)])
    first, second = (e.ensemble_score(df, renormalise=x).collect() for x in (True, False))
    assert first[0]["fraud_probability"] == second[0]["fraud_probability"] == 0.815
    assert first[1]["fraud_probability"] == 0.8643 and second[1]["fraud_probability"] == 0.605
    assert first[2]["predicted_risk"] == 99
    assert first[3]["fraud_probability"] == 0.0
    made = e.batch_predict(df).collect()
    assert made[0]["contributing_factors"] == ["AnomalyPattern", "XGBoost:0.90", "SequenceAnomaly", "CriticalRisk"]
    assert made[3]["transaction_id"] == "unknown" and made[3]["contributing_factors"] == []


def test_fallback(spark):
    df = spark.createDataFrame([("a", 250.0), ("b", 500.0), ("c", 501.0), ("d", 9000.0), ("e", None)], "transaction_id string, amount double")
    rows = e.batch_predict(df).collect()
    assert [r["fraud_probability"] for r in rows] == [0.25, 0.5, 0.501, 1.0, None]
    assert [r["is_fraud"] for r in rows] == [False, False, True, True, None]
    assert [r["risk_score"] for r in rows] == [25, 50, 50, 99, None]
    assert rows[0]["contributing_factors"] == ["FallbackHeuristic"] and rows[0]["model_scores"] == {"fallback": 0.25}


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 10, "chunk_rows": 6}])
def test_auc_and_roc_against_counting_pairs(spark, sizes):
    rng = np.random.default_rng(5)
    y, s = rng.random(150) < 0.4, np.round(rng.random(150), 2)
    df = spark.createDataFrame([(bool(a), float(b)) for a, b in zip(y, s)], "y boolean, s double")
    pos, neg = s[y][:, None], s[~y][None, :]
    want = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert v.auc_roc(df, "y", "s", **sizes).first()["auc"] == pytest.approx(want)
    curve = v.roc_curve(df, "y", "s", **sizes).orderBy("threshold").collect()
    assert len(curve) == len(set(s))
    for r in curve:
        assert r["tpr"] == pytest.approx((s[y] >= r["threshold"]).mean())
        assert r["fpr"] == pytest.approx((s[~y] >= r["threshold"]).mean())


def test_single_class_and_empty_cells(spark):
    df = spark.createDataFrame([(True, 0.9), (True, 0.2)], "y boolean, s double")
    assert v.auc_roc(df, "y", "s").first()["auc"] is None
    assert v.classification_metrics(df, "y", "s").first().asDict() == {
        "accuracy": 0.5, "precision": 1.0, "recall": 0.5, "f1": pytest.approx(2 / 3)}
    assert {(r["label"], r["predicted"]): r["count"] for r in v.confusion_matrix(df, "y", "s").collect()} == {
        (1, 1): 1, (0, 1): 0, (1, 0): 1, (0, 0): 0}
