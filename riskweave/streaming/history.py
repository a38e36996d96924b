"""A stream's past in bounded form: the rows of the look-back, and one summary a user for all that is older.

A batch reads the stored rows of its own users from the last `days` days, and per user one carry row that
stands for everything before (how many rows, the sums of their positions, the last time) and one per known
device. So its cost follows the look-back and never the age of the stream.

Rows are written once a batch, and runs of `fan` batches are rewritten as one, runs of these again, and so
on: after any number of batches there are at most `fan` folders a level. When a day leaves the look-back
its rows are folded into the summaries and its folders deleted, one batch later, so that a repeated
batch still finds what its first try found.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskweave.operators.joins import merchant_daily_counts
from riskweave.sources.folders import drop_folder, folder_values, folders
from riskweave.streaming.state import BUCKETS, CarriedRows, KeyedTable

LEVELS = 4
_LONG_AGO = date(1970, 1, 1)
_CLOCK = "newest date, horizon date"


@dataclass
class BoundedHistory:
    """Past transactions for `batch_features`, with the interface of `UserHistory`.

    `days` must cover the longest look-back (30). A row that comes after its day was folded gets look-back
    features from the rows still there, counts in the summaries, and sees those of its user. `sequences` are not served: they
    need features of rows however old.
    """

    path: str
    days: int = 31
    buckets: int = BUCKETS
    fan: int = 100

    def __post_init__(self) -> None:
        if self.fan < 2 or self.days < 31:
            raise ValueError("at least two runs a level, and days enough for the 30-day look-back")

    # -- places ---------------------------------------------------------------------------------

    def _run(self, level: int, run: int) -> str:
        return f"{self.path}/rows/level={level}/run={run}"

    def _users(self, spark: SparkSession, types: dict[str, T.DataType]) -> KeyedTable:
        return self._summary(spark, types, "users", "n long, lat double, lng double")

    def _devices(self, spark: SparkSession, types: dict[str, T.DataType]) -> KeyedTable:
        return self._summary(spark, types, "devices", None)

    def _summary(self, spark: SparkSession, types: dict[str, T.DataType], name: str, values: str | None) -> KeyedTable:
        own = [T.StructField("device_id", types["device_id"])] if values is None else T._parse_datatype_string(values).fields
        last = [T.StructField("last_ts", T.TimestampType()), T.StructField("last_id", types["transaction_id"])]
        schema = T.StructType([T.StructField("user_id", types["user_id"]), *own, *last])
        return KeyedTable(spark, f"{self.path}/{name}", ["user_id"], schema, self.buckets)

    def _merchants(self, spark: SparkSession) -> KeyedTable:
        return KeyedTable(spark, f"{self.path}/merchants", ["merchant"], "merchant string, day date, n long, fraud long", self.buckets)

    def _clock(self, spark: SparkSession) -> CarriedRows:
        return CarriedRows(spark, f"{self.path}/clock", T._parse_datatype_string(_CLOCK))

    def _times(self, spark: SparkSession, batch_id: int) -> tuple[date | None, date | None]:
        """The newest day seen before this batch, and the first day whose rows are still kept as rows."""
        row = self._clock(spark).before(batch_id).first()
        return (None, None) if row is None else (row["newest"], row["horizon"])

    # -- reading --------------------------------------------------------------------------------

    def runs_before(self, spark: SparkSession, batch_id: int) -> list[str]:
        """The folders that together hold the rows of all earlier batches, at most `fan` a level."""
        out = []
        for level in range(LEVELS):
            size = self.fan**level
            first = 0 if level == LEVELS - 1 else batch_id // (size * self.fan) * self.fan
            known = [r for r in folders(spark, f"{self.path}/rows/level={level}", "run") if first <= r < batch_id // size]
            out += [self._run(level, r) for r in known if folder_values(spark, self._run(level, r), "day")]
        return out

    def _rows(self, spark: SparkSession, schema: T.StructType, runs: list[str]) -> DataFrame:
        whole = T.StructType([f for f in schema.fields if f.name != "day"] + [T.StructField("day", T.DateType())])
        if not runs:
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).option("basePath", f"{self.path}/rows").parquet(*runs).select(*whole.names)

    def rows_before(self, batch: DataFrame, batch_id: int, ts: str = "ts") -> DataFrame:
        """Stored rows of the batch's users within the look-back, and their carry rows. `_weight` is null for a row
        itself, the number of rows that a user's carry row stands for, and 0 for a known device."""
        spark, types = batch.sparkSession, {f.name: f.dataType for f in batch.schema.fields}
        _, horizon = self._times(spark, batch_id)
        users = batch.select("user_id").distinct()
        rows = self._rows(spark, batch.schema, self.runs_before(spark, batch_id))
        if horizon is not None:
            rows = rows.where((F.col("day") >= F.lit(horizon)) | F.col("day").isNull())
        rows = rows.drop("day").join(users, "user_id", "left_semi").withColumn("_weight", F.lit(None).cast("long"))
        totals, devices = self._users(spark, types), self._devices(spark, types)
        touched = totals.touched(users)

        def carry(table: KeyedTable, **values) -> DataFrame:
            known = table.read(batch_id, touched).join(users, "user_id", "left_semi")
            given = {"user_id": F.col("user_id"), "transaction_id": F.col("last_id"), ts: F.col("last_ts"), **values}
            return known.select(*[given.get(n, F.lit(None)).cast(types[n]).alias(n) for n in batch.columns], (F.col("n") if "n" in known.columns else F.lit(0)).cast("long").alias("_weight"))

        mean = carry(totals, latitude=F.col("lat"), longitude=F.col("lng"))
        return rows.unionByName(mean).unionByName(carry(devices, device_id=F.col("device_id")))

    def merchant_days(self, batch: DataFrame, batch_id: int, ts: str = "ts") -> DataFrame:
        """Counts per merchant of the batch and day, up to and including this batch."""
        new = merchant_daily_counts(batch, ts)
        table = self._merchants(batch.sparkSession)
        old = table.read(batch_id, table.touched(new)).join(new.select("merchant").distinct(), "merchant", "left_semi")
        return old.unionByName(new).groupBy("merchant", "day").agg(F.sum("n").alias("n"), F.sum("fraud").alias("fraud"))

    # -- writing --------------------------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int, ts: str = "ts") -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("day", F.to_date(ts))
        newest, horizon = self._times(spark, batch_id)
        self._tidy(spark, batch_id, horizon)
        rows.write.mode("overwrite").partitionBy("day").parquet(self._run(0, batch_id))
        here = rows.agg(F.max("day")).first()[0]
        latest = max((d for d in (newest, here) if d is not None), default=None)
        moved = latest - timedelta(days=self.days) if latest is not None else None
        self._fold(rows, batch_id, ts, horizon, moved)
        counts = merchant_daily_counts(batch, ts)
        old = F.lit(moved if moved is not None else _LONG_AGO)

        def combine(some: DataFrame) -> DataFrame:
            day = F.when(F.col("day") < old, F.lit(_LONG_AGO)).otherwise(F.col("day"))
            return some.groupBy("merchant", day.alias("day")).agg(F.sum("n").alias("n"), F.sum("fraud").alias("fraud"))

        self._merchants(spark).merge(counts, batch_id, combine)
        self._join_runs(spark, batch.schema, batch_id)
        self._clock(spark).hand_on(spark.createDataFrame([(latest, moved)], _CLOCK), batch_id)

    def _fold(self, rows: DataFrame, batch_id: int, ts: str, horizon: date | None, moved: date | None) -> None:
        """Put the days that leave the look-back, and this batch's rows of days long gone, into the summaries."""
        if moved is None:
            return
        spark, types = rows.sparkSession, {f.name: f.dataType for f in rows.schema.fields}
        past = self._rows(spark, rows.schema, self.runs_before(spark, batch_id))
        first = F.lit(horizon if horizon is not None else _LONG_AGO)
        gone = past.where((F.col("day") >= first) & (F.col("day") < F.lit(moved))).unionByName(rows.where(F.col("day") < F.lit(moved)).select(*past.columns))
        last = F.max(F.struct(F.col(ts).alias("t"), F.col("transaction_id").alias("i"))).alias("_l")
        users = gone.groupBy("user_id").agg(
            F.count("*").alias("n"), F.sum(F.col("latitude").cast("double")).alias("lat"), F.sum(F.col("longitude").cast("double")).alias("lng"), last
        ).select("user_id", "n", "lat", "lng", F.col("_l.t").alias("last_ts"), F.col("_l.i").alias("last_id"))
        devices = gone.groupBy("user_id", "device_id").agg(last).select("user_id", "device_id", F.col("_l.t").alias("last_ts"), F.col("_l.i").alias("last_id"))
        newest = F.max(F.struct("last_ts", "last_id")).alias("_l")

        def totals(some: DataFrame) -> DataFrame:
            summed = some.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("lat").alias("lat"), F.sum("lng").alias("lng"), newest)
            return summed.select("user_id", "n", "lat", "lng", "_l.*")

        def known(some: DataFrame) -> DataFrame:
            return some.groupBy("user_id", "device_id").agg(newest).select("user_id", "device_id", "_l.*")

        self._users(spark, types).merge(users, batch_id, totals)
        self._devices(spark, types).merge(devices, batch_id, known)

    def _join_runs(self, spark: SparkSession, schema: T.StructType, batch_id: int) -> None:
        """Rewrite each run of `fan` folders that this batch completes as one folder of the next level."""
        for level in range(1, LEVELS):
            if (batch_id + 1) % self.fan**level:
                break
            run = (batch_id + 1) // self.fan**level - 1
            parts = [self._run(level - 1, r) for r in range(run * self.fan, (run + 1) * self.fan)]
            parts = [p for p in parts if folder_values(spark, p, "day")]
            if parts:
                self._rows(spark, schema, parts).repartition("day").write.mode("overwrite").partitionBy("day").parquet(self._run(level, run))

    def _tidy(self, spark: SparkSession, batch_id: int, horizon: date | None) -> None:
        """Delete what batches before this one have put elsewhere: runs that were joined, days that were folded."""
        for level in range(LEVELS):
            joined = batch_id // self.fan ** (level + 1) * self.fan if level < LEVELS - 1 else 0
            for run in folders(spark, f"{self.path}/rows/level={level}", "run"):
                place = self._run(level, run)
                if run < joined:
                    drop_folder(spark, place)
                    continue
                kept = folder_values(spark, place, "day")
                gone = [d for d in kept if horizon is not None and d[:4].isdigit() and date.fromisoformat(d) < horizon]
                for day in gone:
                    drop_folder(spark, f"{place}/day={day}")
                if kept and len(gone) == len(kept):
                    drop_folder(spark, place)
