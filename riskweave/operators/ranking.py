"""Sorted and limited lists. Sort and limit stay together so only the top rows are merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.functions import columns as c
from riskweave.functions.history import Measure, before


def latest_transactions(df: DataFrame, limit: int = 50, ts: str = "ts") -> DataFrame:
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    return df.orderBy(F.desc(ts), F.desc("transaction_id")).limit(limit)


def latest_alerts(alerts: DataFrame, condition: Column | None = None, limit: int = 20, ts: str = "timestamp") -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    rows = alerts if condition is None else alerts.where(condition)
    return rows.orderBy(F.desc(ts), F.desc("transaction_id")).limit(limit)


def head_rows(df: DataFrame, n: int, by: str = "transaction_id") -> DataFrame:
    return df.orderBy(by).limit(n)


def tail_rows(df: DataFrame, n: int, by: str = "transaction_id") -> DataFrame:
    return df.orderBy(F.desc(by)).limit(n)


def placed(df: DataFrame, by: Column, then: list[str], **sizes: int) -> DataFrame:
    """Adds `place`, 1 for the smallest `by`; `then` breaks ties and must do so fully.

    Places are balanced running counts, so a sort of the whole table needs no task that sees it all.
    """
    rows = df.withColumns({"_all": F.lit(0), "_by": by, "_then": F.struct(*then)})
    counted = before(rows, ["_all"], "_by", "_then", [Measure("_n", F.lit(1))], **sizes)
    return counted.select(*df.columns, (F.col("_n") + 1).cast("int").alias("place"))


def sample_rows(df: DataFrame, n: int, ident: str = "transaction_id", seed: int = 42) -> DataFrame:
    """Exactly `n` rows (all of them when there are fewer), chosen by a seeded hash of the id.

    Rows fall into 65,536 hash slots. Counting slots finds the one where `n` is reached: slots
    before it are taken whole and only that one slot is sorted, so no task sees the whole sample.
    """
    slots = 65_536
    hashed = df.withColumn("_h", c.id_hash(F.col(ident), seed)).withColumn("_slot", F.floor(F.col("_h") / slots))
    sizes = hashed.groupBy("_slot").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_slot"))
    cut = sizes.select("_slot", "_n", upto.alias("_upto")).where(F.col("_upto") >= n).agg(
        F.coalesce(F.min("_slot"), F.lit(slots)).alias("_cut"),
        F.min_by(F.col("_n") - F.col("_upto") + n, "_slot").alias("_missing"),
    )
    marked = hashed.crossJoin(F.broadcast(cut)).where(F.col("_slot") <= F.col("_cut"))
    whole = marked.where(F.col("_slot") < F.col("_cut")).select(*df.columns)
    order = Window.partitionBy("_slot").orderBy("_h", ident)
    part = marked.where(F.col("_slot") == F.col("_cut")).withColumn("_rank", F.row_number().over(order))
    return whole.unionByName(part.where(F.col("_rank") <= F.col("_missing")).select(*df.columns))
