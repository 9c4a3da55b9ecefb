"""Whole tables in folders, on any file system that Spark reaches.

A folder counts once its write has been committed (it holds ``_SUCCESS``). A versioned table
is a folder of such folders, ``version=N``: a new version is written beside the others and
counts as soon as it is whole, so readers never see a half of it.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from linklake.session import work_folder

KEPT_VERSIONS = 2  # the newest, and the one before for readers that still use it


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if it is missing."""
    store, place = _place(spark, folder)
    return sorted(entry.getPath().getName() for entry in store.listStatus(place)) if store.exists(place) else []


def is_whole(spark: SparkSession, folder: str) -> bool:
    store, place = _place(spark, f"{folder}/_SUCCESS")
    return store.exists(place)


def mark_whole(spark: SparkSession, folder: str, parts: list[str]) -> None:
    """Mark folders under a folder as whole; missing ones are made."""
    store, _ = _place(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for part in parts:
        store.create(path(f"{folder}/{part}/_SUCCESS"), True).close()


def delete(spark: SparkSession, folder: str) -> None:
    store, place = _place(spark, folder)
    store.delete(place, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file if there is none; of several that try, one succeeds."""
    store, place = _place(spark, path)
    try:
        store.create(place, False).close()
    except Py4JJavaError as problem:
        if "AlreadyExists" in problem.java_exception.getClass().getName() or store.exists(place):
            return False
        raise
    return True


def move_files(spark: SparkSession, folder: str, target: str) -> None:
    """Move the data files of a folder into another on the same file system, and drop the folder.
    Files that Spark writes have names of their own, so none is replaced."""
    store, place = _place(spark, target)
    for name in names(spark, folder):
        if not name.startswith(("_", ".")):
            source = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
            if not store.rename(source, spark._jvm.org.apache.hadoop.fs.Path(place, name)):
                raise OSError(f"cannot move {name} to {target}")
    store.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared working folder and read again."""
    path = work_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def numbered(spark: SparkSession, folder: str, key: str) -> list[int]:
    """Numbers of the whole folders ``key=N``, in order."""
    found = [int(n.split("=", 1)[1]) for n in names(spark, folder) if n.startswith(f"{key}=")]
    return sorted(n for n in found if is_whole(spark, f"{folder}/{key}={n}"))


def versions(spark: SparkSession, folder: str) -> list[int]:
    return numbered(spark, folder, "version")


def read_version(spark: SparkSession, folder: str, number: int, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/version={number}")


def write_version(frame: DataFrame, folder: str, number: int) -> list[int]:
    """Write a version that counts from its commit on; drops versions too old to be read.
    Returns the numbers that are left."""
    spark = frame.sparkSession
    frame.write.mode("overwrite").parquet(f"{folder}/version={number}")
    known = versions(spark, folder)
    for old in known[:-KEPT_VERSIONS]:
        delete(spark, f"{folder}/version={old}")
    return known[-KEPT_VERSIONS:]
