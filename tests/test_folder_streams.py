"""The registered streams on a table that is a folder of part files, read in several micro-batches."""

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from riskweave.plans import ORACLES, QUERIES, streams

STREAMS = [n for n in QUERIES if n.startswith("stream_")]


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    """The small tables, the events as four part files in time order."""
    path = str(tmp_path_factory.mktemp("tables"))
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    events = spark.read.parquet(f"{small}/events.parquet")
    for k in range(4):
        events.where(F.floor(F.col("event_id") / 250) == k).coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    return path


def test_all_streams_are_covered():
    assert len(STREAMS) == 20 and all(n in ORACLES for n in STREAMS)


@pytest.mark.parametrize("name", STREAMS)
def test_folder_gives_the_rows_of_the_batch(spark, small, folder, name, monkeypatch):
    monkeypatch.setattr(streams, "BATCH", {"maxFilesPerTrigger": "1"})
    assert compare(spark, duck(small), name, folder, QUERIES, ORACLES) is None
