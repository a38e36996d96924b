"""Stream sources: a topic, or files that stand in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Reading starts at the newest message and survives lost ones.
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **KAFKA_DEFAULTS, **options}


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system Spark reads is a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def stream_source(spark: SparkSession, kind: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """`kind="kafka"` needs `servers` and `topic`; "json", "parquet" and "text" need `path`.

    File streams take `maxFilesPerTrigger` to bound a micro-batch, topics `maxOffsetsPerTrigger`.
    """
    reader = spark.readStream
    if kind == "kafka":
        return reader.format("kafka").options(**kafka_options(**options)).load()
    path = options.pop("path")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(kind).options(**options).load(path)


def replay(spark: SparkSession, kind: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """Everything the source holds now, as a bounded batch from the earliest record on."""
    if kind == "kafka":
        bounded = kafka_options(**options) | {"startingOffsets": "earliest", "endingOffsets": "latest"}
        return spark.read.format("kafka").options(**bounded).load()
    path = options.pop("path")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(kind).options(**options).load(path)
