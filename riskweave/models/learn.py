"""Supervised models and their data preparation on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.functions.columns import id_hash
from riskweave.models import boosting, perceptron
from riskweave.models.boosting import AUC_BINS, stop_round  # noqa: F401
from riskweave.operators.features import SEQUENCE
from riskweave.operators.projections import balance_features, clean_numeric, high_amount_p95, type_one_hot
from riskweave.schemas import FEATURES, PAYMENT_TYPES

PAYMENT_FEATURES = [
    "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "balance_change_orig", "balance_change_dest", "is_dest_new", "amount_to_balance_ratio", "is_high_amount",
    *[f"type_{t}" for t in PAYMENT_TYPES],
]


def payment_features(payments: DataFrame, amounts: DataFrame | None = None, **sizes: int) -> DataFrame:
    """Balance features, large-amount flag and type flags, with no missing or infinite value left. `amounts` as in `high_amount_p95`."""
    rows = type_one_hot(balance_features(high_amount_p95(payments, amounts=amounts, **sizes)))
    return clean_numeric(rows, PAYMENT_FEATURES)


def feature_matrix(df: DataFrame, names: Sequence[str] = FEATURES, output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="keep").transform(df)


def stratified_split(
    df: DataFrame, ident: str = "transaction_id", test_percent: int = 20, seed: int = 42, label: str = "is_fraud",
    names: tuple[str, str] = ("test", "train"), output: str = "split",
) -> DataFrame:
    """Adds `split`: of each label's rows the `test_percent` percent with the smallest id hashes are test.

    No repartition or retry moves a row from one side to the other. As for a sample, hash slots are
    counted per label; slots before the one where the share is reached are test as a whole, and only the
    rows of that slot are sorted.
    """
    hashed = df.withColumn("_h", id_hash(F.col(ident), seed)).withColumn("_slot", F.floor(F.col("_h") / 65_536))
    by_label = Window.partitionBy("_label")
    sizes = hashed.groupBy(F.col(label).alias("_label"), "_slot").agg(F.count("*").alias("_n")).select(
        "_label", "_slot", "_n", F.sum("_n").over(by_label.orderBy("_slot")).alias("_upto"),
        F.floor(F.sum("_n").over(by_label) * F.lit(test_percent) / 100 + 0.5).alias("_wanted"),
    )
    cut = sizes.where("_upto >= _wanted").groupBy("_label").agg(
        F.min("_slot").alias("_cut"), F.min_by(F.col("_wanted") - F.col("_upto") + F.col("_n"), "_slot").alias("_missing")
    )
    # A row a label: a shuffle join would bring all rows of a label into one task.
    marked = hashed.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("_label")))
    apart = marked.where("_slot <> _cut").withColumn("_test", F.col("_slot") < F.col("_cut"))
    order = Window.partitionBy("_label", "_slot").orderBy("_h", ident)
    within = marked.where("_slot = _cut").withColumn("_test", F.row_number().over(order) <= F.col("_missing"))
    both = apart.unionByName(within)
    return both.withColumn(output, F.when(F.col("_test"), names[0]).otherwise(names[1])).select(*df.columns, output)


def balance_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Negatives per positive."""
    y = F.col(label).cast("boolean")
    return df.agg(F.try_divide(F.count_if(~y), F.count_if(y)).alias("weight"))


def fit_boosted(
    df: DataFrame, names: Sequence[str] = FEATURES, label: str = "is_fraud", rounds: int = 300, depth: int = 8,
    step: float = 0.05, subsample: float = 0.8, colsample: float = 0.8, positive_weight: float | None = 5.0,
    validation: str | None = None, patience: int = 20, ident: str = "transaction_id", seed: int = 42,
) -> PipelineModel:
    """Boosted trees on the log loss, one weighted regression tree a round.

    A tree sees its own draw of columns and of rows. Its target is (y - p) / p(1 - p) at the weight p(1 - p),
    so its splits and leaves are Newton steps. Columns that are not drawn are zero for it, and a constant is
    never split. Rows are drawn by a hash of `ident`, or of all features where there is no such column.
    `positive_weight=None` balances the classes. `validation` names a boolean column: its rows are not learned
    from, and after `patience` rounds without a better AUC on them the trees up to the best round are kept.
    """
    if positive_weight is None:
        positive_weight = balance_weight(df, label).first()["weight"] or 1.0
    y, names = F.col(label).cast("boolean"), list(names)
    key = [ident] if ident in df.columns else names
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    held = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    rows = assembler.transform(df.where(y.isNotNull()))
    packs, grid, sample = boosting.packed(
        rows, vector_to_array("features"), y, held, F.xxhash64(F.xxhash64(*key), F.lit(seed)), subsample, seed)
    trees = boosting.fit_packs(
        packs, grid, sample, rounds, depth, step, subsample, colsample, float(positive_weight), validation is not None, patience, seed)
    return PipelineModel(stages=[assembler, boosting.as_model(df.sparkSession, trees, step, len(names), depth, seed)])


def boosted_scores(model: PipelineModel, df: DataFrame, output: str = "xgboost") -> DataFrame:
    """Adds the fraud probability."""
    scored = model.transform(df).withColumn(output, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def feature_importance(spark, names: Sequence[str] = FEATURES, model: PipelineModel | None = None) -> DataFrame:
    """(feature, importance); all alike when there is no model."""
    names = list(names)
    values = [1.0 / len(names)] * len(names)
    if model is not None:  # columns after the last one that is split on have no entry
        found = model.stages[-1].featureImportances.toArray().tolist()
        values = found + [0.0] * (len(names) - len(found))
    return spark.createDataFrame(list(zip(names, values)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def sequence_features(df: DataFrame, sequence: str = "sequence") -> DataFrame:
    """The rows of a sequence, oldest first, as one vector."""
    return df.withColumn("features", array_to_vector(F.flatten(F.col(sequence))))


def fit_sequence(
    sequences: DataFrame, width: int = 120, layers: Sequence[int] = (64, 32), rounds: int = 50, seed: int = 42,
    validation: str | None = None, step: int = 10,
) -> PipelineModel:
    """A perceptron over the scaled features of the previous ten transactions.

    `validation` names a boolean column. Its rows are not learned from; after every `step` rounds
    they are scored, and the fit ends with the weights before the loss rose.
    """
    part = _part(F.lit(True), validation)
    packs = perceptron.packed(sequences, F.flatten("sequence"), F.col("is_fraud"), part)
    return _fitted(packs, width, width, layers, rounds, seed, validation, step)


def sequence_packs(rows: DataFrame, train: Column, validation: str | None = None, length: int = SEQUENCE, ident: str = "transaction_id") -> DataFrame:
    """The sequences of `features.sequence_rows`, written once for fit and scores. Learned from: the `train` rows outside of `validation`."""
    return perceptron.packed(rows, F.col("features"), F.col("is_fraud"), _part(train, validation), F.col("_whole"), length, ident)


def fit_sequence_packs(
    packs: DataFrame, columns: int = len(FEATURES), length: int = SEQUENCE, layers: Sequence[int] = (64, 32), rounds: int = 50, seed: int = 42,
    validation: str | None = None, step: int = 10,
) -> PipelineModel:
    """`fit_sequence` on packs made with the same `validation`."""
    return _fitted(packs, columns * length, columns, layers, rounds, seed, validation, step)


def _part(train: Column, validation: str | None) -> Column:
    held = F.lit(False) if validation is None else F.col(validation)
    return F.when(train & held, perceptron.JUDGED).when(train & ~held, perceptron.LEARNED).otherwise(perceptron.NEITHER)


def _fitted(packs, width, columns, layers, rounds, seed, validation, step) -> PipelineModel:
    return PipelineModel(stages=[perceptron.fit_packs(packs, [width, *layers, 2], columns, rounds, seed, validation is not None, step)])


def sequence_pack_scores(model: PipelineModel, packs: DataFrame, output: str = "lstm", columns: int = len(FEATURES), ident: str = "transaction_id") -> DataFrame:
    """(ident, score): what `sequence_scores` gives for the sequences of the packs."""
    return perceptron.pack_scores(model.stages[-1], packs, columns, ident, output)


def sequence_scores(model: PipelineModel, sequences: DataFrame, output: str = "lstm") -> DataFrame:
    scored = model.transform(sequence_features(sequences)).withColumn(output, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def fit_pca(df: DataFrame, names: Sequence[str], k: int = 2) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    return Pipeline(stages=[assembler, scaler, PCA(k=k, inputCol="scaled", outputCol="components")]).fit(df)


def pca_2d(model: PipelineModel, df: DataFrame) -> DataFrame:
    parts = vector_to_array("components")
    return model.transform(df).withColumns({"pc1": parts[0], "pc2": parts[1]}).drop("features", "scaled", "components")
