"""Files, views and store forms."""

from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from riskweave.models.ensemble import batch_predict
from riskweave.plans.rows import json_messages
from riskweave.schemas import PAYMENT, STORED_PREDICTION, STORED_TRANSACTION, TIMED_TRANSACTION, TRANSACTION
from riskweave.session import materialize, shared_dir
from riskweave.sources import files, stores
from riskweave.sources.tables import payments, transactions


def test_payments_csv_round_trip(spark, small, tmp_path):
    rows = payments(spark, small).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAYMENT])
    rows.write.option("header", True).csv(f"{tmp_path}/csv")
    back = files.read_payments_csv(spark, f"{tmp_path}/csv")
    assert [f.dataType for f in back.schema] == [f.dataType for f in PAYMENT]
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0


def test_json_lines_round_trip(spark, small, tmp_path):
    from riskweave.operators.projections import parse_transactions

    rows = parse_transactions(json_messages(transactions(spark, small)))
    files.write_jsonl(rows, f"{tmp_path}/jsonl")
    back = files.read_jsonl(spark, f"{tmp_path}/jsonl")
    assert back.schema == TRANSACTION
    assert back.exceptAll(rows).count() == 0 and back.count() == 1000


def test_pandas_types_are_not_narrowed(spark):
    pdf = pd.DataFrame({"n": [2**40], "x": [0.1], "b": [True], "s": ["a"], "t": [pd.Timestamp("2024-01-01")]})
    df = files.typed_from_pandas(spark, pdf)
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "b": "boolean", "s": "string", "t": "timestamp"}
    row = df.first()
    assert (row["n"], row["x"], row["t"]) == (2**40, 0.1, datetime(2024, 1, 1))


def test_views(spark, small):
    files.register_views(payments(spark, small))
    got = spark.sql("SELECT amount_category, count(*) AS n FROM txn_enriched GROUP BY 1").collect()
    assert sum(r["n"] for r in got) == spark.sql("SELECT * FROM transactions").count() == 6000


def test_kept_lets_go(spark, small):
    with files.kept(transactions(spark, small, region=False)) as rows:
        assert rows.is_cached and rows.count() == 1000
    assert not rows.is_cached


def test_store_forms(spark, small):
    rows = transactions(spark, small)
    stored = stores.stored_transactions(rows)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in STORED_TRANSACTION]
    gaps = stores.stored_transactions(rows.limit(1).withColumns({"risk_score": F.lit(None).cast("int"), "is_fraud": F.lit(None).cast("boolean")})).first()
    assert gaps["risk_score"] == 0 and gaps["is_fraud"] is False
    made = stores.stored_predictions(batch_predict(rows), F.lit(datetime(2024, 1, 1)))
    assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in STORED_PREDICTION]
    assert made.first()["model_scores"].startswith('{"fallback"')


def test_metrics_and_predictions_expire(spark):
    t = [datetime(2024, 1, 1, h) for h in range(4)]
    df = spark.createDataFrame([("a", 1.0, t[0]), ("a", 2.0, t[2]), ("b", 3.0, t[1])], "name string, value double, updated_at timestamp")
    assert [tuple(r) for r in stores.metric_snapshot(df, F.lit(datetime(2024, 1, 1, 2, 30))).select("name", "value").collect()] == [("a", 2.0)]
    assert stores.metric_snapshot(df, F.lit(t[3])).count() == 0
    made = spark.createDataFrame([(1, t[0], 0.1), (1, t[1], 0.9)], "transaction_id long, scored_at timestamp, p double")
    assert stores.latest_prediction(made, F.lit(t[1])).first()["p"] == 0.9


def test_missing_table_reads_as_empty(spark, tmp_path):
    assert stores.read_or_empty(spark, f"{tmp_path}/none", PAYMENT).count() == 0


def test_timed_schema_differs_in_one_type():
    changed = [a.name for a, b in zip(TRANSACTION, TIMED_TRANSACTION) if a.dataType != b.dataType]
    assert changed == ["timestamp"]


def test_materialized_table_lies_in_the_shared_folder(spark, small):
    rows = transactions(spark, small, region=False)
    table = materialize(rows)
    assert table.dtypes == rows.dtypes and table.count() == 1000
    assert table.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(shared_dir(spark).removeprefix("file:").lstrip("/"))


def test_jdbc_append_writes_in_batches(spark, small, monkeypatch):
    """No database here: only the call is checked."""
    calls = []
    rows = transactions(spark, small, region=False)
    monkeypatch.setattr(type(rows.write), "jdbc", lambda self, *args, **kwargs: calls.append((args, kwargs)))
    stores.jdbc_append(rows, "jdbc:db://host/x", "transactions", {"user": "u"})
    assert calls == [(("jdbc:db://host/x", "transactions"), {"mode": "append", "properties": {"batchsize": "10000", "user": "u"}})]
