"""File sources and sinks. Schemas are given, never inferred: inference would read the data twice."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T

from riskweave.operators.projections import enrich_payments
from riskweave.schemas import PAYMENT, TRANSACTION


def read_payments_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYMENT).option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION) -> DataFrame:
    return spark.read.schema(schema).json(path)


def pandas_schema(pdf: pd.DataFrame) -> T.StructType:
    """Spark types by pandas dtype, wide enough to keep every value."""

    def spark_type(dtype) -> T.DataType:
        if pd.api.types.is_bool_dtype(dtype):
            return T.BooleanType()
        if pd.api.types.is_integer_dtype(dtype):
            return T.LongType()
        if pd.api.types.is_float_dtype(dtype):
            return T.DoubleType()
        if pd.api.types.is_datetime64_any_dtype(dtype):
            return T.TimestampType()
        return T.StringType()

    return T.StructType([T.StructField(str(n), spark_type(t)) for n, t in pdf.dtypes.items()])


def typed_from_pandas(spark: SparkSession, pdf: pd.DataFrame) -> DataFrame:
    return spark.createDataFrame(pdf, pandas_schema(pdf))


def register_views(payments: DataFrame) -> None:
    """The views `transactions` and `txn_enriched` for SQL."""
    payments.createOrReplaceTempView("transactions")
    enrich_payments(payments).createOrReplaceTempView("txn_enriched")


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` for several actions and let it go afterwards."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()
