"""Partition folders of tables, on any file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_values(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values v of the folders `name=v` below a path; none where it does not exist."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    found = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return [n.removeprefix(f"{name}=") for n in found if n.startswith(f"{name}=")]


def folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders `name=n`, ascending."""
    return sorted(int(v) for v in folder_values(spark, path, name))


def drop_folder(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.mkdirs(place)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether the job that writes this table has ended."""
    place, files = _place(spark, f"{path}/_SUCCESS")
    return files.exists(place)
