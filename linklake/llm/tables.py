"""Reading the given tables and cutting lineage between stages."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake.session import work_folder


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_linklake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    base = Path(tempfile.mkdtemp(prefix="linklake-"), "linklake")
    context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
    context._linklake_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it has ended, not when the driver
    next collects its garbage."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once under ``spark.checkpoint.dir`` and read again.

    Later stages start from the files, so a lost executor costs only its own stage and no
    shuffle of before is needed again.
    """
    spark = frame.sparkSession
    path = work_folder(spark, name)
    with _shuffles_cleaned(spark):
        frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for frame in tables:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


BROADCAST_KEYS = 200_000  # keys at most that are sent to all tasks; more are joined by a shuffle


def sized(keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """Keys (a stored table of a long) ready to join: broadcast if they are few, else hashed."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys.hint("shuffle_hash")


NO_ID = 1 - (1 << 63)  # stands for a null id inside tasks


def ids(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def ids_back(column: Column) -> Column:
    return F.nullif(column, F.lit(NO_ID))
