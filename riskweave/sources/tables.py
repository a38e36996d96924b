"""The two inputs of every query, as views over the given star-schema tables.

`transactions` is one row per event with its customer's region; `payments` is one row per line
item with the balances of both parties. `TXN_SQL` and `PAY_SQL` state the same views in SQL for
the cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.schemas import FRAUD_TYPES, MERCHANTS, STATUSES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def as_transactions(events: DataFrame) -> DataFrame:
    """Event rows as transaction rows without the region; works on a batch or a stream."""
    n, user = F.col("event_id"), F.col("user_id")
    fraud = F.col("is_fraud")
    return (
        events.select(
            n.alias("transaction_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            user,
            (F.col("value") * 10).alias("amount"),
            F.col("event_type").alias("channel"),
            _pick(MERCHANTS, n % 8).alias("merchant"),
            F.get_json_object("props", "$.k").try_cast("int").alias("risk_score"),
            _pick(STATUSES, n % 5).alias("status"),
            (user * 10 + n % 3).alias("device_id"),
            ((user * 37) % 160 - 80 + (n % 11 - 5) * 2.0).alias("latitude"),
            ((user * 53) % 360 - 180 + (n % 13 - 6) * 3.0).alias("longitude"),
            (8 + (n * 13) % 120).cast("int").alias("processing_ms"),
        )
        .withColumn("is_fraud", (F.col("risk_score") > 72) | (F.col("transaction_id") % 17 == 0))
        .withColumn("fraud_type", F.when(fraud, _pick(FRAUD_TYPES, F.col("transaction_id") % 6)))
    )


def user_regions(spark: SparkSession, folder: str) -> DataFrame:
    """user_id → region. Nation and region are fixed small lists; the planner sizes the joins."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, folder, "region").select("r_regionkey", "r_name")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region"))
    )


def transactions(spark: SparkSession, folder: str, region: bool = True) -> DataFrame:
    """One row per event, with a null region where the customer is unknown. `region=False` leaves the
    customer join out where it is not needed; the rows are the same."""
    rows = as_transactions(table(spark, folder, "events"))
    return rows.join(user_regions(spark, folder), "user_id", "left") if region else rows


def payments(spark: SparkSession, folder: str, balances: bool = True) -> DataFrame:
    """One row per line item of an order. `balances=False` leaves out the balance columns and their
    joins; the rows are the same, as an unknown party has null balances."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    priority, amount = F.col("o_orderpriority"), F.col("l_extendedprice")
    fraud = (F.col("l_returnflag") == "R") & priority.isin("2-HIGH", "3-MEDIUM")
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = [
        (F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")) * 24).alias("step"),
        F.when(priority == "1-URGENT", "PAYMENT")
        .when(priority == "2-HIGH", "TRANSFER")
        .when(priority == "3-MEDIUM", "CASH_OUT")
        .when(priority == "4-NOT SPECIFIED", "CASH_IN")
        .when(priority == "5-LOW", "DEBIT")
        .alias("type"),
        amount.alias("amount"),
        F.col("o_custkey").alias("nameOrig"),
        F.col("l_suppkey").alias("nameDest"),
        fraud.cast("int").alias("isFraud"),
        (fraud & (amount > 90000)).cast("int").alias("isFlaggedFraud"),
    ]
    if balances:
        customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
        supplier = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
        rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
            supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left"
        )
        known = F.col("c_acctbal").isNotNull()
        held = F.when(known, F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 10)
        columns += [
            held.alias("oldbalanceOrg"),
            F.when(known, F.greatest(held - amount, F.lit(0.0))).alias("newbalanceOrig"),
            F.col("s_acctbal").alias("oldbalanceDest"),
            (F.col("s_acctbal") + amount).alias("newbalanceDest"),
        ]
    return rows.select(*columns)


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TXN_SQL = f"""txn AS (
  SELECT *, CASE WHEN is_fraud THEN {_sql_list(FRAUD_TYPES)}[CAST(transaction_id % 6 + 1 AS INTEGER)] END AS fraud_type
  FROM (SELECT *, risk_score > 72 OR transaction_id % 17 = 0 AS is_fraud
    FROM (SELECT e.event_id AS transaction_id, e.ts, e.user_id, e.value * 10 AS amount,
        e.event_type AS channel, r.r_name AS region,
        {_sql_list(MERCHANTS)}[CAST(e.event_id % 8 + 1 AS INTEGER)] AS merchant,
        CAST(e.props->>'$.k' AS INTEGER) AS risk_score,
        {_sql_list(STATUSES)}[CAST(e.event_id % 5 + 1 AS INTEGER)] AS status,
        e.user_id * 10 + e.event_id % 3 AS device_id,
        CAST((e.user_id * 37) % 160 - 80 + (e.event_id % 11 - 5) * 2.0 AS DOUBLE) AS latitude,
        CAST((e.user_id * 53) % 360 - 180 + (e.event_id % 13 - 6) * 3.0 AS DOUBLE) AS longitude,
        CAST(8 + (e.event_id * 13) % 120 AS INTEGER) AS processing_ms
      FROM events e LEFT JOIN (customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey) ON c.c_custkey = e.user_id)))"""

PAY_SQL = """pay AS (
  SELECT *, CASE WHEN oldbalanceOrg IS NOT NULL THEN greatest(oldbalanceOrg - amount, 0) END AS newbalanceOrig,
    oldbalanceDest + amount AS newbalanceDest,
    CAST(isFraud = 1 AND amount > 90000 AS INTEGER) AS isFlaggedFraud
  FROM (SELECT CAST(datediff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) * 24 AS INTEGER) AS step,
      CASE o.o_orderpriority WHEN '1-URGENT' THEN 'PAYMENT' WHEN '2-HIGH' THEN 'TRANSFER'
        WHEN '3-MEDIUM' THEN 'CASH_OUT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN'
        WHEN '5-LOW' THEN 'DEBIT' END AS type,
      l.l_extendedprice AS amount, o.o_custkey AS nameOrig, l.l_suppkey AS nameDest,
      CASE WHEN c.c_acctbal IS NOT NULL THEN greatest(c.c_acctbal, 0) * 10 END AS oldbalanceOrg, s.s_acctbal AS oldbalanceDest,
      CAST(l.l_returnflag = 'R' AND o.o_orderpriority IN ('2-HIGH', '3-MEDIUM') AS INTEGER) AS isFraud
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey))"""
