"""A table that is replaced while streams join it.

A file list is fixed when a stream starts, so a static side read then never changes. Here each micro-batch looks
up the newest version, notes its number before it reads, and a repeated batch reads the version it noted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskweave.sources.folders import drop_folder, folder_values, folders, is_written, make_folder
from riskweave.streaming.sinks import _triggered


class VersionedTable:
    """Whole versions of a table in folders `version=n`, one publisher, any number of named readers.

    A reader notes in `reader=<name>/batch=b/version=n` what batch b reads and keeps the notes of two batches.
    Publishing deletes the versions that are older than the last but one and than every noted one, so folders do
    not grow in number with the batches. A reader that will not come back must be forgotten (`forget`).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        """Complete versions, ascending; one whose job has not ended is not there yet."""
        return [n for n in folders(self.spark, self.path, "version") if is_written(self.spark, self._folder(n))]

    def publish(self, rows: DataFrame) -> int:
        """Write the next version. One that was begun and not ended is written again."""
        known = self.versions()
        number = known[-1] + 1 if known else 0
        rows.write.mode("overwrite").parquet(self._folder(number))
        noted = [n for reader in folder_values(self.spark, self.path, "reader") for n in self._notes(reader).values()]
        for n in known:
            if n < min([*noted, number - 1]):
                drop_folder(self.spark, self._folder(n))
        return number

    def read(self, reader: str, batch_id: int) -> DataFrame:
        """The version of this batch: the noted one, else the newest, which is noted."""
        notes = self._notes(reader)
        number = notes.get(batch_id)
        while number is None:
            newest = self.versions()
            if not newest:
                raise ValueError(f"nothing has been published in {self.path}")
            make_folder(self.spark, f"{self.path}/reader={reader}/batch={batch_id}/version={newest[-1]}")
            # A publisher may have deleted the version before it saw the note.
            if newest[-1] in self.versions():
                number = newest[-1]
            else:
                drop_folder(self.spark, f"{self.path}/reader={reader}/batch={batch_id}")
        for b in notes:
            if b < batch_id - 1:
                drop_folder(self.spark, f"{self.path}/reader={reader}/batch={b}")
        return self.spark.read.parquet(self._folder(number))

    def forget(self, reader: str) -> None:
        drop_folder(self.spark, f"{self.path}/reader={reader}")

    def _folder(self, number: int) -> str:
        return f"{self.path}/version={number}"

    def _notes(self, reader: str) -> dict[int, int]:
        place = f"{self.path}/reader={reader}"
        noted = {b: folders(self.spark, f"{place}/batch={b}", "version") for b in folders(self.spark, place, "batch")}
        return {b: found[-1] for b, found in noted.items() if found}


def refreshed_join(
    stream: DataFrame, table: VersionedTable, key: Sequence[str], path: str, checkpoint: str, reader: str = "stream",
    every: str | None = None,
) -> StreamingQuery:
    """The stream's rows with the columns of the table's version at each micro-batch, as partitions `batch=<id>`.

    Rows without a partner stay, with nulls.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.join(table.read(reader, batch_id), list(key), "left")
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _triggered(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), every).start()
