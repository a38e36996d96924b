"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.session import shared_dir, tune

# Words are runs of bytes outside this set: space, tab, line feed, vertical tab, form feed, return.
WORD_SQL_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path for this run in the folder all executors share; nothing is created yet."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str = "table", **options: str) -> DataFrame:
    """`df` written in the shared folder and read back: cuts the plan and survives lost executors."""
    return stored_at(df, kind, **options)[0]


def stored_at(df: DataFrame, kind: str = "table", **options: str) -> tuple[DataFrame, str]:
    """As `stored`, with the table's place, for a table that a later one will replace."""
    path = new_folder(df.sparkSession, kind)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of this run that no plan reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def row_number(docs: DataFrame) -> Column:
    """A number for each row of a stored table, the same in every reading of it.

    It is made of the row's place within its task's part of the files. How files are dealt to tasks is fixed by
    `spark.sql.files.minPartitionNum`, which `tune` sets; without it, it would follow the cores registered at
    the moment, and two readings of one job could number rows differently.
    """
    tune(docs.sparkSession)
    return F.monotonically_increasing_id()


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, longer where `df` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def whole_text(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hex string whose length is a multiple of five digits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = F.sequence(F.lit(0), (F.length(hex_digest) / 5).cast("int") - 1)

    def four_letters(i: Column) -> Column:
        value = F.conv(F.substring(hex_digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        letter = [F.substring(alphabet, F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*letter)

    return F.concat_ws("", F.transform(groups, four_letters))


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path and the path within it, for code that runs inside tasks."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)
