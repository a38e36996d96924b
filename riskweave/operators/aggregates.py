"""Summaries. Every one is a single conditional aggregation with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions import columns as c
from riskweave.functions.stats import exact_percentiles, exact_percentiles_of, with_rows_below


def fraud_count(flag: str = "is_fraud") -> Column:
    return F.count_if(F.col(flag).cast("boolean"))


def rate(flag: str = "is_fraud") -> Column:
    """Share of flagged rows in percent, unrounded."""
    return fraud_count(flag) * F.lit(100.0) / F.count(flag)


def dataset_totals(payments: DataFrame) -> DataFrame:
    total, fraud = F.count("*"), fraud_count("isFraud")
    return payments.agg(
        total.alias("total"),
        fraud.alias("fraud"),
        fraud_count("isFlaggedFraud").alias("flagged"),
        c.percent(fraud, total).alias("fraud_rate_pct"),
    )


def fraud_amount_stats(payments: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return payments.where("isFraud = 1").agg(
        F.round(c.money_avg(amount), 4).alias("avg_fraud_amount"),
        c.money_sum(amount).alias("total_fraud_amount"),
        F.count("*").alias("count"),
    )


def fraud_types_top(payments: DataFrame, n: int = 5) -> DataFrame:
    by_type = payments.where("isFraud = 1").groupBy("type").agg(
        F.count("*").alias("count"), F.round(c.money_avg(F.col("amount")), 4).alias("avg_amount")
    )
    return by_type.orderBy(F.desc("count"), "type").limit(n)


def top_users(payments: DataFrame, n: int = 10, user: str = "nameOrig") -> DataFrame:
    by_user = payments.groupBy(user).agg(
        F.count("*").alias("txn_count"),
        c.money_sum(F.col("amount")).alias("total_amount"),
        fraud_count("isFraud").alias("fraud_count"),
    )
    return by_user.orderBy(F.desc("txn_count"), user).limit(n)


def fraud_per_type(payments: DataFrame) -> DataFrame:
    return payments.groupBy("type").agg(
        F.count("*").alias("total"), fraud_count("isFraud").alias("fraud")
    ).orderBy(F.desc("fraud"), "type")


def fraud_rate_by(df: DataFrame, dim: str, flag: str = "is_fraud") -> DataFrame:
    return df.groupBy(dim).agg(
        F.count("*").alias("total_txns"),
        fraud_count(flag).alias("fraud_count"),
        c.percent(fraud_count(flag), F.count("*")).alias("fraud_rate_pct"),
    ).orderBy(F.desc("fraud_rate_pct"), dim)


def fraud_share_total(payments: DataFrame) -> DataFrame:
    fraud = F.col("isFraud") == 1
    return payments.agg(
        c.money_sum(F.when(fraud, F.col("amount"))).alias("fraud_amount"),
        c.percent(F.count_if(fraud), F.count("*")).alias("fraud_pct"),
    )


def stats_by_label(payments: DataFrame) -> DataFrame:
    averages = {
        "avg_amount": "amount", "avg_old_balance": "oldbalanceOrg",
        "avg_new_balance": "newbalanceOrig", "avg_dest_old_balance": "oldbalanceDest",
    }
    return payments.groupBy((F.col("isFraud") == 1).alias("is_fraud")).agg(
        F.count("*").alias("count"),
        *[F.round(c.money_avg(F.col(src)), 2).alias(name) for name, src in averages.items()],
    )


def overall_stats(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return df.agg(
        F.count("*").alias("total_txns"),
        fraud_count().alias("fraud_count"),
        c.percent(fraud_count(), F.count("*")).alias("fraud_rate_pct"),
        F.round(c.money_avg(amount), 2).alias("avg_amount"),
        F.round(F.stddev_samp(amount), 2).alias("std_amount"),
        F.round(F.min(amount), 2).alias("min_amount"),
        F.round(F.max(amount), 2).alias("max_amount"),
    )


def fraud_by_region_type(df: DataFrame) -> DataFrame:
    return df.where("is_fraud").groupBy("region", "fraud_type").agg(F.count("*").alias("count"))


def rate_by(df: DataFrame, dim: str, flag: str = "is_fraud") -> DataFrame:
    return df.groupBy(dim).agg(rate(flag).alias("fraud_rate_pct")).orderBy("fraud_rate_pct", dim)


def hourly_stats(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(
        F.count("*").alias("total"), fraud_count().alias("fraud"), rate().alias("fraud_rate_pct")
    ).orderBy("hour")


def rate_pivot(df: DataFrame, row: str, column: str, values: Sequence[str], flag: str = "is_fraud") -> DataFrame:
    """One column per listed value and per other value that occurs (a missing one is `null`).

    Cells are counted in long form first, so the values are found in a small table. Empty cells are null.
    """
    cells = df.groupBy(row, F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("_v")).agg(rate(flag).alias("_rate"))
    wide = cells.groupBy(row).pivot("_v").agg(F.first("_rate"))
    missing = {v: F.lit(None).cast("double") for v in values if v not in wide.columns}
    others = [n for n in wide.columns if n != row and n not in values]
    return wide.withColumns(missing).select(row, *values, *others)


def merchant_ranking(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant").agg(
        F.count("*").alias("txns"),
        fraud_count().alias("fraud"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk"),
        F.round(c.money_avg(F.col("amount")), 4).alias("avg_amount"),
        rate().alias("fraud_rate_pct"),
    ).orderBy(F.desc("fraud_rate_pct"), "merchant")


def value_counts(df: DataFrame, dim: str) -> DataFrame:
    counts = df.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), dim)


def type_share(df: DataFrame) -> DataFrame:
    """Fraud types with their share of all fraud, the total taken from the small grouped result."""
    counts = df.where("is_fraud").groupBy("fraud_type").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "fraud_type", "count", (F.col("count") * F.lit(100.0) / F.col("_total")).alias("share_pct")
    )


def describe_numeric(df: DataFrame, names: Sequence[str], **sizes: int) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column, in long form; NaN counts as missing."""
    basic = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return exact_percentiles_of(df, names, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, basic, **sizes).where("count > 0")


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over the whole column's range; the last one is closed on both sides.

    A constant column falls into the middle bin. Null, NaN and infinite values are in no bin.
    """
    df = df.where(c.is_finite(F.col(value)))
    limits = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    lo, hi, x = F.col("_lo"), F.col("_hi"), F.col(value)
    place = F.coalesce(F.floor((x - lo) * bins / F.nullif(hi - lo, F.lit(0.0))), F.lit(bins // 2))
    placed = df.crossJoin(F.broadcast(limits)).withColumn(
        "bin", F.least(place, F.lit(bins - 1)).cast("int")
    )
    return placed.groupBy("bin", *([by] if by else [])).agg(F.count("*").alias("count"))


def pearson(a: str, b: str) -> Column:
    """Correlation, null for a constant column; the built-in one fails on those in ANSI mode."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair in one pass, as (a, b, r) rows."""
    pairs = list(combinations(names, 2))
    wide = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("r")) for a, b in pairs])
    return wide.select(F.explode(rows).alias("_p")).select("_p.*")


def correlation_with_label(df: DataFrame, names: Sequence[str], label: str = "is_fraud") -> DataFrame:
    """Correlation of each feature with the label, strongest first; null for a constant feature."""
    wide = df.withColumn("_label", F.col(label).cast("double")).agg(*[pearson(n, "_label").alias(n) for n in names])
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("r")) for n in names])
    return wide.select(F.explode(rows).alias("_p")).select("_p.*").orderBy(F.desc_nulls_last("r"), "feature")


def kpi_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"), fraud_count().alias("fraud"), rate().alias("fraud_rate_pct"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk"),
        F.round(c.money_avg(F.col("amount")), 4).alias("avg_amount"),
    )


def volume_share(df: DataFrame) -> DataFrame:
    total, fraud = c.money_sum(F.col("amount")), c.money_sum(F.when(F.col("is_fraud"), F.col("amount")))
    return df.agg(
        total.alias("total_volume"), F.coalesce(fraud, F.lit(0.0)).alias("fraud_volume"),
        F.round(F.try_divide(fraud * 100.0, total), 4).alias("share_pct"),
    )


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.coalesce("fraud_type", F.lit("Unknown")).alias("fraud_type")).agg(
        F.count("*").alias("count")
    )


def dashboard_metrics(df: DataFrame) -> DataFrame:
    """Totals plus fraud counts by type and by region as maps.

    All come from one grouped pass over (type, region), whose cells, as many as there are pairs of
    types and regions, are put together in one row.
    """
    cells = df.groupBy("fraud_type", "region").agg(
        F.count("*").alias("n"), fraud_count().alias("fraud"), F.sum("risk_score").alias("risk"),
        F.count("risk_score").alias("scored"),
    )
    cell = F.struct(*[F.coalesce(n, F.lit("Unknown")).alias(n) for n in ("fraud_type", "region")], "fraud")
    row = cells.agg(
        F.sum("n").alias("total_transactions"), F.sum("fraud").alias("total_fraud"),
        c.percent(F.sum("fraud"), F.sum("n"), 2).alias("fraud_rate"),
        (F.sum("risk") / F.sum("scored")).alias("avg_risk_score"),
        F.collect_list(F.when(F.col("fraud") > 0, cell)).alias("_cells"),
    )

    def counts(dim: str) -> Column:
        names = F.array_sort(F.array_distinct(F.transform("_cells", lambda x: x[dim])))
        of = lambda name: F.filter("_cells", lambda x: x[dim] == name)
        sums = F.transform(names, lambda name: F.aggregate(of(name), F.lit(0).cast("long"), lambda n, x: n + x["fraud"]))
        return F.map_from_arrays(names, sums)

    return row.withColumns({"fraud_by_type": counts("fraud_type"), "fraud_by_region": counts("region")}).drop("_cells")


def etl_batch_stats(df: DataFrame, sequence: str = "transaction_id", size: int = 100) -> DataFrame:
    """Per batch of `size` consecutive records; the last, shorter batch is kept.

    `sequence` is a number, or a text id whose digits are one (`TXN-0000123`); ids without
    digits share the batch null.
    """
    return df.groupBy(F.floor(c.sequence_number(df, sequence) / size).alias("batch")).agg(
        F.count("*").alias("total"), fraud_count().alias("fraud"),
        (F.sum("risk_score") / F.count("risk_score")).alias("avg_risk"),
        F.sum("risk_score").alias("risk_sum"), F.count("risk_score").alias("scored"),
    )


def fraud_burst(df: DataFrame, width: str = "1 hour", limit: int = 10, ts: str = "ts") -> DataFrame:
    """Windows with at least `limit` frauds."""
    return df.where("is_fraud").groupBy(F.window(ts, width)).agg(F.count("*").alias("frauds")).where(
        F.col("frauds") >= limit
    )


def latency_alert(df: DataFrame, width: str = "1 hour", limit_ms: float = 200, ts: str = "ts") -> DataFrame:
    """Windows whose mean processing time exceeds the limit."""
    return df.groupBy(F.window(ts, width)).agg(F.avg("processing_ms").alias("avg_ms")).where(
        F.col("avg_ms") > limit_ms
    )


def top_category(df: DataFrame, dim: str, flag: str = "is_fraud") -> DataFrame:
    """The value of `dim` with the highest rate; the first one by name on a tie."""
    rates = df.groupBy(dim).agg(rate(flag).alias("fraud_rate_pct"))
    return rates.orderBy(F.desc("fraud_rate_pct"), dim).limit(1)


def entity_edges(df: DataFrame) -> DataFrame:
    """User–merchant edges from fraud rows, with the number of rows and the highest risk."""
    return df.where("is_fraud").groupBy("user_id", "merchant").agg(
        F.count("*").alias("links"), F.max("risk_score").alias("max_risk")
    )


def entity_degree(df: DataFrame) -> DataFrame:
    """Links per node, counted from the grouped edges instead of the raw rows."""
    edges = entity_edges(df)
    users = edges.select(F.lit("user").alias("kind"), F.col("user_id").cast("string").alias("node"), "links")
    shops = edges.select(F.lit("merchant").alias("kind"), F.col("merchant").alias("node"), "links")
    return users.unionByName(shops).groupBy("kind", "node").agg(F.sum("links").alias("degree"))


def latency_percentiles(df: DataFrame, ts: str = "ts", **sizes: int) -> DataFrame:
    """Mean, median and 99th percentile of the processing time by hour of day."""
    rows = df.select(F.hour(ts).alias("hour"), F.col("processing_ms").alias("ms"))
    return rows.groupBy("hour").agg(F.avg("ms").alias("avg_ms")).join(
        exact_percentiles(rows, "ms", {"p50_ms": 0.5, "p99_ms": 0.99}, ["hour"], **sizes), "hour"
    )


def risk_rank(df: DataFrame, **sizes: int) -> DataFrame:
    """Merchants ranked by fraud rate, equal rates sharing a rank. Ranks are counted from the
    distinct rates, so no task has to hold all merchants."""
    rates = df.groupBy("merchant").agg(rate().alias("fraud_rate_pct"))
    places = rates.groupBy("fraud_rate_pct").agg(F.count("*").alias("n")).withColumn("_down", -F.col("fraud_rate_pct"))
    ranked = with_rows_below(places, order="_down", **sizes)
    return rates.join(ranked.select("fraud_rate_pct", (F.col("below") + 1).cast("int").alias("rank")), "fraud_rate_pct")
