"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on. UTC keeps hours and days independent of the machine;
# adaptive execution picks join strategies and partition counts from measured sizes; stream state
# lives in RocksDB, off the heap. How a table is split into tasks would follow the cores registered at that
# moment; a fixed number instead keeps row numbers taken from a scan alike while executors come and go.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.minPartitionNum": "32",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_TUNED = "spark.riskweave.tuned"


def tune(spark: SparkSession) -> SparkSession:
    """Sets `RUNTIME` once in a session; what its owner changes afterwards stays."""
    if spark.conf.get(_TUNED, None) is None:
        for name, value in {**RUNTIME, _TUNED: "true"}.items():
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks. On a cluster use the submitted one and `tune` it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskweave")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    Only a local session without one gets a temporary folder, deleted when Python ends: a folder of
    one machine would be lost with that machine on a cluster. There the folder's owner decides how
    long its tables are kept.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="riskweave-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Used before iterative fits: the work is done once, and a lost executor costs a re-read instead
    of a recomputation of the whole plan.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
