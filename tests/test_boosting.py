"""The fit of boosted trees on packs: Spark's draws and numbers, MLlib's trees, and few passes over the rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from riskweave.models import boosting, learn
from riskweave.session import materialize

NAMES = list("abcd")


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.normal(0, 1, 1500), rng.integers(0, 5, 1500), rng.random(1500) * (rng.random(1500) < 0.6), np.round(rng.random(1500), 1)])
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 1, 1500) > 0.8
    rows = [(i, *map(float, r), bool(t), i % 4 == 0) for i, (r, t) in enumerate(zip(x, y))]
    # One partition: sums in another order may differ in their last digits, and splits of equal gain with them.
    return materialize(spark.createDataFrame(rows, "transaction_id long, a double, b double, c double, d double, is_fraud boolean, held boolean").coalesce(1))


def lines(tree):
    return tree.toDebugString.split("\n")[1:]


def passes(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_further_tree_takes_a_pass_a_level(spark, labelled):
    fits = [lambda n=n: learn.fit_boosted(labelled, NAMES, rounds=n, depth=5, validation="held", patience=99) for n in (2, 5)]
    few, more = (passes(spark, f"fit-{i}", fit) for i, fit in enumerate(fits))
    assert 0 < more - few <= 3 * 5


def test_draws_and_exponentials_are_those_of_spark(spark):
    df = spark.range(300).select(F.xxhash64("id").alias("key"), ((F.col("id") - 150) / 7).alias("x"))
    got = df.select(F.xxhash64("key", F.lit(42)), "x", F.exp("x"), *[F.xxhash64("key", F.lit(42), F.lit(n)) for n in (0, 1, 299)]).collect()
    begun, x, exps = np.array([r[0] for r in got]), np.array([r[1] for r in got]), [r[2] for r in got]
    for place, number in enumerate((0, 1, 299), start=3):
        assert boosting.hashed(begun, number).tolist() == [r[place] for r in got]
    assert boosting._exp(x).tolist() == exps


@pytest.mark.parametrize("seed", [1, 2])
def test_a_tree_is_the_one_that_mllib_grows(labelled, seed):
    """The second of two rounds, on the rows drawn for it, with weights and targets from the margins of the first."""
    settings = dict(depth=6, step=0.7, colsample=1.0, positive_weight=3.0, seed=seed)
    first, second = learn.fit_boosted(labelled, NAMES, rounds=2, **settings).stages[-1].trees
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(labelled)
    rows = first.transform(rows).withColumn("p", 1 / (1 + F.exp(-0.7 * F.col("prediction")))).drop("prediction")
    drawn = F.pmod(F.xxhash64(F.xxhash64("transaction_id"), F.lit(seed), F.lit(1)), F.lit(1 << 20)) < int(0.8 * (1 << 20))
    spread = F.col("p") * (1 - F.col("p"))
    target = rows.where(drawn).select(
        "features", ((F.col("is_fraud").cast("double") - F.col("p")) / spread).alias("target"), (F.when(F.col("is_fraud"), 3.0).otherwise(1.0) * spread).alias("weight"))
    want = DecisionTreeRegressor(labelCol="target", weightCol="weight", maxDepth=6).fit(target)
    assert lines(second) == lines(want) and len(lines(want)) > 60


@pytest.mark.parametrize("sample", [150, 10_000])
def test_margins_of_the_fit_are_those_of_the_model(spark, labelled, sample, monkeypatch):
    """Also where thresholds come from a part of the rows only, over several packs and cuts."""
    monkeypatch.setattr(boosting, "SAMPLE", sample)
    monkeypatch.setattr(boosting, "PACK_ROWS", 200)
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(labelled)
    packs, grid, few = boosting.packed(rows, vector_to_array("features"), F.col("is_fraud"), F.col("held"), F.xxhash64("transaction_id"), 0.8, 3)
    assert grid.exact == (sample > 1500) and (len(few.label) == 1125 if grid.exact else 100 < len(few.label) < 300)
    trees = boosting.fit_packs(packs, grid, few, 9, 4, 0.3, 0.8, 0.8, 2.0, True, 99, 3)
    found = []
    for pack in packs.rdd.map(boosting._opened).collect():
        for tree in trees:
            pack = boosting.moved(pack, tree, 0.3)
        found += pack.margin.tolist()
    model = boosting.as_model(spark, trees, 0.3, 4, 4, 3)
    want = [r["m"] for r in model.transform(rows).select((2 * vector_to_array("rawPrediction")[1]).alias("m")).collect()]
    assert sorted(found) == pytest.approx(sorted(want)) and len(set(found)) > 50
    assert model.getNumTrees == len(trees) and model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_missing_features_are_refused_where_they_would_be_learned_from(labelled):
    gap = labelled.withColumn("a", F.when(F.col("transaction_id") != 4, F.col("a")))
    held = learn.fit_boosted(gap, NAMES, rounds=1, depth=2, validation="held")
    assert learn.boosted_scores(held, gap).where("xgboost IS NULL").count() == 0
    with pytest.raises(Exception, match="missing or infinite"):
        learn.fit_boosted(gap, NAMES, rounds=1, depth=2)


@pytest.mark.parametrize("most", [2, 32])
def test_sums_of_many_tasks_are_added_up_in_tasks_and_empty_ones_send_nothing(spark, most, monkeypatch):
    monkeypatch.setattr(boosting, "PARTS", most)
    rdd = spark.sparkContext.parallelize(range(5), 9)
    one, two = boosting._summed(rdd, lambda part: [np.full(3, sum(x := list(part))), np.array([len(x), 1])])
    assert one.tolist() == [10, 10, 10] and two.tolist() == [5, 5]


def test_packs_are_dealt_out_evenly(spark):
    sizes = [5, 900, 10, 300, 310, 290, 7]
    packs = spark.sparkContext.parallelize(sizes, 4).map(lambda n: boosting.Pack([], np.zeros(n), *[np.zeros(0)] * 3))
    loads = boosting._dealt(packs, 2).map(lambda pack: len(pack.label)).glom().map(sum).collect()
    assert len(loads) == 2 and sum(loads) == sum(sizes) and max(loads) - min(loads) < 30
