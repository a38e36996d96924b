"""Combine model scores into one decision, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Weights, limits and names of the combined score.
WEIGHTS = {"isolation_forest": 0.25, "xgboost": 0.45, "lstm": 0.30}
FRAUD_LIMIT = 0.5
ANOMALY_LIMIT = 0.6
CRITICAL_RISK = 80
FALLBACK_AMOUNT = 1000.0


def rounded(value: Column, digits: int = 4) -> Column:
    """Half-up rounding on the decimal value, so the binary tail cannot tip a tie."""
    return F.round(value.cast("decimal(18,10)"), digits).cast("double")


def risk_points(probability: Column) -> Column:
    """0 to 99; the limits are applied before the cast, so no probability is too large for it."""
    return F.when(probability.isNotNull(), F.greatest(F.lit(0.0), F.least(probability * 100, F.lit(99.0)))).cast("int")


def ensemble_score(df: DataFrame, weights: dict[str, float] | None = None, renormalise: bool = True) -> DataFrame:
    """Weighted mean of the score columns named in `weights`.

    A null score means the model gave none. With `renormalise` the other weights are scaled up;
    without it the missing score counts as 0.
    """
    weights = WEIGHTS if weights is None else weights
    total = sum((F.coalesce(F.col(n), F.lit(0.0)) * w for n, w in weights.items()), F.lit(0.0))
    if renormalise:
        present = sum((F.when(F.col(n).isNotNull(), w).otherwise(0.0) for n, w in weights.items()), F.lit(0.0))
        total = F.coalesce(F.try_divide(total, present), F.lit(0.0))
    scores = F.create_map(*[x for n in weights for x in (F.lit(n), rounded(F.coalesce(F.col(n), F.lit(0.0))))])
    scored = df.withColumn("_p", total)
    return scored.withColumns({
        "fraud_probability": rounded(F.col("_p")),
        "is_fraud_predicted": F.col("_p") > FRAUD_LIMIT,
        "predicted_risk": risk_points(F.col("_p")),
        "model_scores": scores,
    }).drop("_p")


def contributing_factors(
    forest: str = "isolation_forest", boosted: str = "xgboost", sequence: str = "lstm", risk: str = "predicted_risk"
) -> Column:
    """Reasons in a fixed order; the boosted score is shown with two digits."""
    shown = F.round(F.col(boosted).cast("decimal(18,10)"), 2).cast("decimal(4,2)").cast("string")
    return F.array_compact(F.array(
        F.when(F.col(forest) > ANOMALY_LIMIT, "AnomalyPattern"),
        F.when(F.col(boosted) > FRAUD_LIMIT, F.concat(F.lit("XGBoost:"), shown)),
        F.when(F.col(sequence) > FRAUD_LIMIT, "SequenceAnomaly"),
        F.when(F.col(risk) > CRITICAL_RISK, "CriticalRisk"),
    ))


def fallback_score(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Score by amount alone, used while no model is fitted."""
    share = F.col(amount) / FALLBACK_AMOUNT
    p = F.when(share > 1.0, 1.0).otherwise(share)
    return df.withColumns({
        "fraud_probability": p,
        "is_fraud_predicted": p > FRAUD_LIMIT,
        "predicted_risk": risk_points(p),
        "model_scores": F.create_map(F.lit("fallback"), p),
        "factors": F.array(F.lit("FallbackHeuristic")),
    })


def batch_predict(df: DataFrame, amount: str = "amount") -> DataFrame:
    """One prediction per row in the outward form; rows without an id read `unknown`."""
    has_models = all(n in df.columns for n in WEIGHTS)
    scored = ensemble_score(df).withColumn("factors", contributing_factors()) if has_models else fallback_score(df, amount)
    return scored.select(
        F.coalesce(F.col("transaction_id").cast("string"), F.lit("unknown")).alias("transaction_id"),
        "fraud_probability",
        F.col("is_fraud_predicted").alias("is_fraud"),
        F.col("predicted_risk").alias("risk_score"),
        "model_scores",
        F.col("factors").alias("contributing_factors"),
    )
