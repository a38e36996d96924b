"""Scoring, evaluation and model queries.

Queries with SQL score by columns of the transactions; the fitted models are checked by rows and by
the invariants in the tests.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.models import ensemble as e, evaluate as v, learn
from riskweave.models.forest import IsolationForest
from riskweave.operators import features as f
from riskweave.plans.registry import pay, query, txn
from riskweave.schemas import FEATURES, GEO_CROSS_BORDER
from riskweave.session import materialize
from riskweave.sources.tables import payments, transactions, user_regions


def lean(spark, d):
    return transactions(spark, d, region=False)


def column_scores(rows):
    """Three score columns read off the transaction; one model is missing on some rows."""
    return rows.withColumns({
        "isolation_forest": F.col("risk_score") / 100.0,
        "xgboost": F.least(F.lit(1.0), F.col("amount") / 1000.0),
        "lstm": F.when(F.col("status") != "CLEARED", (F.col("processing_ms") - 8) / 120.0),
    })


SCORES_SQL = """s AS (SELECT *, risk_score / 100.0::DOUBLE AS f, least(1.0::DOUBLE, amount / 1000.0) AS b,
    CASE WHEN status <> 'CLEARED' THEN (processing_ms - 8) / 120.0::DOUBLE END AS q FROM txn),
  e AS (SELECT *, (0.0::DOUBLE + f * 0.25 + b * 0.45 + coalesce(q, 0) * 0.3) AS total,
    (0.0::DOUBLE + 0.25 + 0.45 + CASE WHEN q IS NOT NULL THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END) AS present FROM s)"""


def _probability(p):
    return f"CAST(round(CAST({p} AS DECIMAL(18,10)), 4) AS DOUBLE)"


def _ensemble(name, renormalise, p):
    @query(name, txn(f"""WITH {SCORES_SQL} SELECT transaction_id, {_probability(p)} AS fraud_probability, {p} > 0.5 AS is_fraud_predicted,
  least(99, CAST(trunc({p} * 100) AS INTEGER)) AS predicted_risk, {_probability('coalesce(q, 0)')} AS lstm_score FROM e"""))
    def _(spark, d):
        scored = e.ensemble_score(column_scores(lean(spark, d)), renormalise=renormalise)
        return scored.select("transaction_id", "fraud_probability", "is_fraud_predicted", "predicted_risk",
                             F.col("model_scores")["lstm"].alias("lstm_score"))


_ensemble("ensemble_score", True, "(total / present)")
_ensemble("ensemble_score_fixed_weights", False, "total")

FACTORS_SQL = """concat_ws(',', CASE WHEN f > 0.6 THEN 'AnomalyPattern' END,
    CASE WHEN b > 0.5 THEN 'XGBoost:' || CAST(CAST(round(CAST(b AS DECIMAL(18,10)), 2) AS DECIMAL(4,2)) AS VARCHAR) END,
    CASE WHEN q > 0.5 THEN 'SequenceAnomaly' END,
    CASE WHEN least(99, CAST(trunc(total / present * 100) AS INTEGER)) > 80 THEN 'CriticalRisk' END)"""


@query("contributing_factors", txn(f"WITH {SCORES_SQL} SELECT transaction_id, {FACTORS_SQL} AS factors FROM e"))
def _(spark, d):
    scored = e.ensemble_score(column_scores(lean(spark, d)))
    return scored.select("transaction_id", F.concat_ws(",", e.contributing_factors()).alias("factors"))


@query("fallback_score", txn("""SELECT transaction_id, least(1.0::DOUBLE, amount / 1000.0) AS fraud_probability, least(1.0::DOUBLE, amount / 1000.0) > 0.5 AS is_fraud_predicted,
  least(99, CAST(trunc(least(1.0::DOUBLE, amount / 1000.0) * 100) AS INTEGER)) AS predicted_risk, 'FallbackHeuristic' AS factors FROM txn"""))
def _(spark, d):
    return e.fallback_score(lean(spark, d)).select(
        "transaction_id", "fraud_probability", "is_fraud_predicted", "predicted_risk", F.concat_ws(",", "factors").alias("factors"))


@query("batch_predict", txn(f"""WITH {SCORES_SQL} SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, {_probability('total / present')} AS fraud_probability,
  total / present > 0.5 AS is_fraud, least(99, CAST(trunc(total / present * 100) AS INTEGER)) AS risk_score, {_probability('b')} AS boosted, {FACTORS_SQL} AS contributing_factors FROM e"""))
def _(spark, d):
    made = e.batch_predict(column_scores(lean(spark, d)))
    return made.select("transaction_id", "fraud_probability", "is_fraud", "risk_score", F.col("model_scores")["xgboost"].alias("boosted"),
                       F.concat_ws(",", "contributing_factors").alias("contributing_factors"))


def judged(spark, d):
    return lean(spark, d).select("transaction_id", "is_fraud", (F.col("risk_score") / 100.0).alias("p"))


JUDGED_SQL = "j AS (SELECT is_fraud AS y, risk_score / 100.0::DOUBLE AS p FROM txn)"
CONFUSION_SQL = f"""{JUDGED_SQL}, c AS (SELECT count(*) FILTER (WHERE y AND p > 0.5) AS tp, count(*) FILTER (WHERE NOT y AND p > 0.5) AS fp,
  count(*) FILTER (WHERE y AND NOT p > 0.5) AS fn, count(*) FILTER (WHERE NOT y AND NOT p > 0.5) AS tn FROM j),
  m AS (SELECT *, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / (tp + fn) AS recall FROM c)"""


@query("classification_metrics", txn(f"""WITH {CONFUSION_SQL} SELECT round(accuracy, 8) AS accuracy, round(precision, 8) AS precision, round(recall, 8) AS recall,
  round(2 * precision * recall / (precision + recall), 8) AS f1 FROM m"""))
def _(spark, d):
    out = v.classification_metrics(judged(spark, d), "is_fraud", "p")
    return out.select(*[F.round(n, 8).alias(n) for n in out.columns])


@query("classification_report", txn(f"""WITH {CONFUSION_SQL} SELECT 'fraud' AS class, round(precision, 8) AS precision, round(recall, 8) AS recall,
  round(2 * precision * recall / (precision + recall), 8) AS f1, tp + fn AS support FROM m UNION ALL
  SELECT 'clean', round(tn::DOUBLE / (tn + fn), 8), round(tn::DOUBLE / (tn + fp), 8),
  round(2 * (tn::DOUBLE / (tn + fn)) * (tn::DOUBLE / (tn + fp)) / (tn::DOUBLE / (tn + fn) + tn::DOUBLE / (tn + fp)), 8), tn + fp FROM m"""))
def _(spark, d):
    out = v.classification_report(judged(spark, d), "is_fraud", "p")
    return out.withColumns({n: F.round(n, 8) for n in ("precision", "recall", "f1")})


@query("confusion_matrix", txn(f"""WITH {JUDGED_SQL} SELECT CAST(l AS INTEGER) AS label, CAST(h AS INTEGER) AS predicted, count(j.y) AS count
  FROM (SELECT unnest([0, 1]) AS l) CROSS JOIN (SELECT unnest([0, 1]) AS h) LEFT JOIN j ON j.y::INTEGER = l AND (j.p > 0.5)::INTEGER = h GROUP BY l, h"""))
def _(spark, d):
    return v.confusion_matrix(judged(spark, d), "is_fraud", "p")


ROC_SQL = """g AS (SELECT p, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM j GROUP BY p)"""


@query("roc_curve", txn(f"""WITH {JUDGED_SQL}, {ROC_SQL} SELECT p AS threshold, round(sum(neg) OVER w / (sum(neg) OVER ())::DOUBLE, 8) AS fpr,
  round(sum(pos) OVER w / (sum(pos) OVER ())::DOUBLE, 8) AS tpr FROM g WINDOW w AS (ORDER BY p DESC)"""))
def _(spark, d):
    out = v.roc_curve(judged(spark, d), "is_fraud", "p")
    return out.select("threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


def _auc_sql(source):
    return f"""r AS (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS place FROM {source})"""


AUC_EXPR = """round((sum(CASE WHEN y THEN place END) - count(*) FILTER (WHERE y) * (count(*) FILTER (WHERE y) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (WHERE y) * count(*) FILTER (WHERE NOT y)), 8) AS auc"""


@query("auc_roc", txn(f"WITH {JUDGED_SQL}, {_auc_sql('j')} SELECT {AUC_EXPR} FROM r"))
def _(spark, d):
    return v.auc_roc(judged(spark, d), "is_fraud", "p").select(F.round("auc", 8).alias("auc"))


@query("model_comparison", txn("""WITH k AS (SELECT 'risk' AS model, is_fraud AS y, risk_score / 100.0::DOUBLE AS p FROM txn UNION ALL
    SELECT 'amount', is_fraud, least(1.0::DOUBLE, amount / 1000.0) FROM txn),
  r AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY p) + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0::DOUBLE AS place FROM k),
  c AS (SELECT model, """ + AUC_EXPR + """, count(*) FILTER (WHERE y AND p > 0.5)::DOUBLE AS tp, count(*) FILTER (WHERE NOT y AND p > 0.5) AS fp, count(*) FILTER (WHERE y AND NOT p > 0.5) AS fn FROM r GROUP BY model)
  SELECT model, auc, round(tp / (tp + fp), 8) AS precision, round(tp / (tp + fn), 8) AS recall, round(2 * tp / (2 * tp + fp + fn), 8) AS f1 FROM c"""))
def _(spark, d):
    rows = lean(spark, d)
    pairs = F.array(
        F.struct(F.lit("risk").alias("model"), (F.col("risk_score") / 100.0).alias("p")),
        F.struct(F.lit("amount").alias("model"), F.least(F.lit(1.0), F.col("amount") / 1000.0).alias("p")))
    long = rows.select(F.col("is_fraud").alias("label"), F.explode(pairs).alias("_m")).select("label", "_m.*")
    out = v.model_comparison(long)
    return out.select("model", *[F.round(n, 8).alias(n) for n in ("auc", "precision", "recall", "f1")])


@query("feature_matrix", pay("""WITH lim AS (SELECT quantile_cont(amount, 0.95) AS q FROM pay)
  SELECT amount AS f0, oldbalanceOrg AS f1, newbalanceOrig AS f2, oldbalanceDest AS f3, newbalanceDest AS f4, oldbalanceOrg - newbalanceOrig AS f5,
  oldbalanceDest - newbalanceDest AS f6, CAST(oldbalanceDest = 0 AS DOUBLE) AS f7, round(amount / (oldbalanceOrg + 1), 8) AS f8, CAST(amount > q AS DOUBLE) AS f9,
  CAST(type = 'PAYMENT' AS DOUBLE) AS f10, CAST(type = 'TRANSFER' AS DOUBLE) AS f11, CAST(type = 'CASH_OUT' AS DOUBLE) AS f12,
  CAST(type = 'CASH_IN' AS DOUBLE) AS f13, CAST(type = 'DEBIT' AS DOUBLE) AS f14 FROM pay, lim"""))
def _(spark, d):
    matrix = learn.feature_matrix(learn.payment_features(payments(spark, d), payments(spark, d, balances=False)), learn.PAYMENT_FEATURES)
    x = vector_to_array("features")
    return matrix.select(*[(F.round(x[i], 8) if i == 8 else x[i]).alias(f"f{i}") for i in range(15)])


@query("balance_weight", txn("SELECT count(*) FILTER (WHERE NOT is_fraud) / (count(*) FILTER (WHERE is_fraud))::DOUBLE AS weight FROM txn"))
def _(spark, d):
    return learn.balance_weight(lean(spark, d))


SPLIT_SQL = """CASE WHEN row_number() OVER (PARTITION BY is_fraud ORDER BY ('0x' || substr(md5('42:' || transaction_id), 1, 8))::BIGINT, transaction_id)
  <= floor(count(*) OVER (PARTITION BY is_fraud) * 20 / 100.0 + 0.5) THEN 'test' ELSE 'train' END"""


@query("stratified_split", txn(f"SELECT transaction_id, is_fraud, {SPLIT_SQL} AS split FROM txn"))
def _(spark, d):
    return learn.stratified_split(lean(spark, d)).select("transaction_id", "is_fraud", "split")


def training_table(spark, d):
    """The 12 features with label, split and, within train, the part that decides when a fit stops."""
    # Written first: each split reads its rows several times.
    rows = materialize(f.transaction_features(
        lean(spark, d), regions=user_regions(spark, d), cross_border=GEO_CROSS_BORDER, keep=["is_fraud", "user_id", "ts"]))
    split = learn.stratified_split(rows)
    held = learn.stratified_split(split, test_percent=10, seed=43, names=("held", "fit"), output="_part")
    return materialize(held.withColumn("validation", F.col("_part") == "held").drop("_part"))


def fitted_boosted(rows):
    return learn.fit_boosted(rows.where("split = 'train'"), positive_weight=None, validation="validation")


def late_scores(rows):
    """(transaction_id, lstm) of every row with ten earlier ones, by a perceptron fitted on train rows only."""
    sequences = f.sequence_rows(rows, keep=["split", "validation"])
    packs = learn.sequence_packs(sequences, F.col("split") == "train", "validation")
    return learn.sequence_pack_scores(learn.fit_sequence_packs(packs, validation="validation"), packs)


def all_scores(spark, d):
    """Every row with the scores of the three models, each fitted on train rows only."""
    rows = training_table(spark, d)
    _, judged_rows = IsolationForest.fit_transform(rows, FEATURES, train=F.col("split") == "train")
    return learn.boosted_scores(fitted_boosted(rows), judged_rows).join(late_scores(rows), "transaction_id", "left")


@query("isolation_forest_scores")
def _(spark, d):
    rows = training_table(spark, d)
    _, scored = IsolationForest.fit_transform(rows, FEATURES, train=F.col("split") == "train")
    return scored.select("transaction_id", "anomaly_score", "isolation_forest", "anomaly")


@query("anomaly_label")
def _(spark, d):
    rows = training_table(spark, d)
    _, scored = IsolationForest.fit_transform(rows, FEATURES, train=F.col("split") == "train")
    return scored.groupBy("is_fraud", "anomaly").agg(F.count("*").alias("count"), F.avg("anomaly_score").alias("avg_score"))


@query("boosted_scores")
def _(spark, d):
    rows = training_table(spark, d)
    return learn.boosted_scores(fitted_boosted(rows), rows).select(
        "transaction_id", "xgboost", (F.col("xgboost") > 0.5).cast("int").alias("predicted"))


@query("feature_importance")
def _(spark, d):
    return learn.feature_importance(spark, model=fitted_boosted(training_table(spark, d)))


@query("sequence_scores")
def _(spark, d):
    return late_scores(training_table(spark, d))


@query("ensemble_trained")
def _(spark, d):
    """All three fitted models combined, with reasons."""
    combined = e.ensemble_score(all_scores(spark, d)).withColumn("factors", F.concat_ws(",", e.contributing_factors()))
    return combined.select("transaction_id", "split", "is_fraud", "fraud_probability", "is_fraud_predicted", "predicted_risk", "factors")


@query("fitted_model_comparison")
def _(spark, d):
    """The fitted models and their combination, judged on the test rows."""
    scored = e.ensemble_score(all_scores(spark, d)).where("split = 'test'")
    models = ("isolation_forest", "xgboost", "lstm", "fraud_probability")
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in models])
    long = scored.select(F.col("is_fraud").alias("label"), F.explode(pairs).alias("_m")).select("label", "_m.*")
    return v.model_comparison(materialize(long.where("p IS NOT NULL")))


@query("pca_2d")
def _(spark, d):
    rows = training_table(spark, d)
    return learn.pca_2d(learn.fit_pca(rows, FEATURES), rows).select("transaction_id", "is_fraud", "pc1", "pc2")


@query("pca_variance")
def _(spark, d):
    shares = learn.fit_pca(training_table(spark, d), FEATURES).stages[-1].explainedVariance.toArray().tolist()
    return spark.createDataFrame(list(enumerate(shares, 1)), "component int, share double")
