"""Classifier quality by distributed counting. `by` (a list of columns) evaluates several models at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions.history import Measure, before


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _counts(df: DataFrame, label: str, predicted: Column, by: Sequence[str]) -> DataFrame:
    y, hat = F.col(label).cast("boolean"), predicted
    return df.groupBy(*by).agg(
        F.count_if(y & hat).alias("tp"), F.count_if(~y & hat).alias("fp"),
        F.count_if(y & ~hat).alias("fn"), F.count_if(~y & ~hat).alias("tn"),
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    counts = _counts(df, label, F.col(score) > threshold, by)
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return counts.select(
        *by, _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), _f1(precision, recall).alias("f1"),
    )


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    counts = _counts(df, label, F.col(score) > threshold, ())
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))

    def row(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        precision, recall = _ratio(hit, hit + wrong), _ratio(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            _f1(precision, recall).alias("f1"), (hit + missed).alias("support"),
        )

    rows = F.array(row("clean", tn, fn, fp), row("fraud", tp, fp, fn))
    return counts.select(F.explode(rows).alias("_r")).select("_r.*")


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All four cells, empty ones included."""
    counts = _counts(df, label, F.col(score) > threshold, ())
    cells = [(1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn")]
    rows = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(hat).alias("predicted"), F.col(n).alias("count")) for y, hat, n in cells
    ])
    return counts.select(F.explode(rows).alias("_r")).select("_r.*")


def _by_score(df: DataFrame, label: str, score: str, by: list[str], **sizes: int) -> DataFrame:
    """Per distinct score: positives and negatives at it and above it, and the totals.

    Scores are counted first, so ties and a coarse score scale shrink the data; the running counts
    are balanced like every other history, whatever the number of distinct scores.
    """
    y = F.col(label).cast("boolean")
    keys = by or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    counts = rows.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    ranked = before(
        counts.withColumn("_down", -F.col("threshold")), keys, "_down", "_down",
        [Measure("pos_above", F.col("pos")), Measure("neg_above", F.col("neg"))], **sizes,
    )
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("pos_total"), F.sum("neg").alias("neg_total"))
    return ranked.join(totals, keys).drop("_down", *([] if by else ["_all"]))


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (), **sizes: int) -> DataFrame:
    """False and true positive rate at every distinct score (predicting fraud at or above it)."""
    scored = _by_score(df, label, score, list(by), **sizes)
    return scored.select(
        *by, "threshold",
        F.try_divide(F.col("neg_above") + F.col("neg"), "neg_total").alias("fpr"),
        F.try_divide(F.col("pos_above") + F.col("pos"), "pos_total").alias("tpr"),
    )


def auc_roc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), **sizes: int) -> DataFrame:
    """Area under the ROC curve; ties count half, null when one class is missing."""
    scored = _by_score(df, label, score, list(by), **sizes)
    won = F.sum(F.col("neg").cast("double") * (F.col("pos_above") + F.col("pos") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return scored.groupBy(*by).agg(F.try_divide(won, pairs).alias("auc"))


def model_comparison(long: DataFrame, label: str = "label", score: str = "p", model: str = "model", **sizes: int) -> DataFrame:
    """AUC, precision, recall and F1 per model of a (model, label, p) frame."""
    return auc_roc(long, label, score, [model], **sizes).join(
        classification_metrics(long, label, score, by=[model]).drop("accuracy"), model
    )
