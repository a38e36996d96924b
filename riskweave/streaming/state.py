"""Tables that carry state from one micro-batch to the next, at a cost that does not grow with the batches.

`KeyedTable` keeps one version of a bucket of keys; a batch rewrites only the buckets it touches, each into a
folder of its own (`bucket=b/batch=n`). A batch reads the newest version before its own, so one that is
repeated starts from the same state and replaces what its first try wrote. Versions nobody reads any more
are deleted one batch later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskweave.sources.folders import drop_folder, folders

BUCKETS = 64


class KeyedTable:
    """Rows by key in buckets, changed by merging a micro-batch.

    `schema` holds the key and value columns. There are at most `buckets` folders with two versions each, so
    listing them costs the same after any number of batches. Batch numbers must grow.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: T.StructType | str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, list(key), buckets
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _versions(self, before: int | None) -> dict[int, int]:
        """The newest version of each bucket, earlier than `before`."""
        newest = {}
        for b in folders(self.spark, self.path, "bucket"):
            known = [n for n in folders(self.spark, f"{self.path}/bucket={b}", "batch") if before is None or n < before]
            if known:
                newest[b] = known[-1]
        return newest

    def read(self, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The table as batch `before` finds it (by default as it is now), or some buckets of it."""
        versions = {b: n for b, n in self._versions(before).items() if only is None or b in only}
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/bucket={b}/batch={n}" for b, n in versions.items()])

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of `rows`; the driver sees at most `buckets` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def merge(self, changes: DataFrame, batch_id: int, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Put `changes` (rows of the schema) into the buckets of their keys.

        `combine` gets the old rows of these buckets and the changes, told apart by the column `_new`, and returns
        the rows that stay. Changes should be aggregated by key, so that a hot key is a row.
        """
        changes = changes.select(*self.schema.names).persist()
        try:
            touched = self.touched(changes)
            if not touched:
                return
            old = self.read(batch_id, touched).withColumn("_new", F.lit(False))
            kept = combine(old.unionByName(changes.withColumn("_new", F.lit(True)))).select(*self.schema.names)
            # A bucket whose rows have all gone still gets a version, as a folder without rows would not be written.
            rows = kept.withColumn("bucket", self.bucket()).repartition(self.buckets, "bucket")
            staged = rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("bucket", "batch")
            staged.option("partitionOverwriteMode", "dynamic").parquet(self.path)
            left = {b for b in touched if batch_id in folders(self.spark, f"{self.path}/bucket={b}", "batch")}
            for b in set(touched) - left:
                self.spark.createDataFrame([], self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/bucket={b}/batch={batch_id}")
            self._forget(touched, batch_id)
        finally:
            changes.unpersist()

    def _forget(self, touched: Sequence[int], batch_id: int) -> None:
        """Delete all but the version before this batch, which a repeated batch still reads."""
        for b in touched:
            known = [n for n in folders(self.spark, f"{self.path}/bucket={b}", "batch") if n < batch_id]
            for n in known[:-1]:
                drop_folder(self.spark, f"{self.path}/bucket={b}/batch={n}")


class MetricCache:
    """Named values with a lifetime: set, increment, read; expired names go when their bucket is next written.

    A table in Spark, read as any other; `now` is given by the caller, so a repeated batch decides alike.
    """

    SCHEMA = "name string, value double, updated_at timestamp, expires_at timestamp"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.table = KeyedTable(spark, path, ["name"], self.SCHEMA, buckets)

    def set(self, values: DataFrame, batch_id: int, now: Column, ttl_seconds: int | None = 3600) -> None:
        """The newest value by name (name, value, updated_at); of equal times the larger. Older ones than the stored change nothing."""
        newest = values.groupBy("name").agg(F.max(F.struct("updated_at", "value")).alias("_v")).select("name", "_v.value", "_v.updated_at")

        def combine(rows: DataFrame) -> DataFrame:
            best = F.max_by(F.struct("value", "updated_at", "expires_at"), F.struct("updated_at", "_new"))
            return rows.where(F.col("_new") | _alive(now)).groupBy("name").agg(best.alias("_v")).select("name", "_v.*")

        self.table.merge(_stamped(newest, ttl_seconds), batch_id, combine)

    def increment(self, steps: DataFrame, batch_id: int, now: Column, ttl_seconds: int | None = None) -> None:
        """Add up steps (name, value, updated_at). A counter whose lifetime has passed starts anew, each step renews it;
        without a lifetime (None) it counts for ever."""
        added = steps.groupBy("name").agg(F.sum("value").alias("value"), F.max("updated_at").alias("updated_at"))

        def combine(rows: DataFrame) -> DataFrame:
            return rows.where(F.col("_new") | _alive(now)).groupBy("name").agg(
                F.sum("value").alias("value"), F.max("updated_at").alias("updated_at"), F.max("expires_at").alias("expires_at"))

        self.table.merge(_stamped(added, ttl_seconds), batch_id, combine)

    def read(self, now: Column, before: int | None = None) -> DataFrame:
        return self.table.read(before).where(_alive(now)).select("name", "value", "updated_at")


def _stamped(rows: DataFrame, ttl_seconds: int | None) -> DataFrame:
    end = F.lit(None).cast("timestamp") if ttl_seconds is None else F.col("updated_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))
    return rows.withColumn("expires_at", end)


def _alive(now: Column) -> Column:
    return F.col("expires_at").isNull() | (F.col("expires_at") > now)


class CarriedRows:
    """A bounded number of rows handed from batch to batch, such as the last hundred of a stream."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def before(self, batch_id: int) -> DataFrame:
        known = [n for n in folders(self.spark, self.path, "batch") if n < batch_id]
        if not known:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={known[-1]}")

    def hand_on(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.schema.names).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        for n in [n for n in folders(self.spark, self.path, "batch") if n < batch_id][:-1]:
            drop_folder(self.spark, f"{self.path}/batch={n}")
