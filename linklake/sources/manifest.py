"""Archive manifests: text lists of archive paths, one a line."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def check_partition(partition: str) -> str:
    """Return a ``YYYY-WW`` partition as it is, or raise ``ValueError``."""
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}", partition):
        raise ValueError(f"invalid partition {partition!r}: use YYYY-WW")
    return partition


def path_pattern(partition: str) -> str:
    # Fixed value: how archive paths of a crawl partition are spelled.
    return (
        rf"crawl-data/CC-MAIN-{check_partition(partition)}"
        r"/segments/[0-9]+\.[0-9]+/.*\.warc\.gz"
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a manifest, plain or gzipped, as ``value``."""
    return spark.read.text(path)


def archive_paths(lines: DataFrame, partition: str) -> DataFrame:
    """Distinct archive paths of a partition found in the lines, as ``path``."""
    found = F.regexp_extract("value", path_pattern(partition), 0).alias("path")
    return lines.select(found).where(F.col("path") != "").distinct()


def pick_first(lines: DataFrame, partition: str, count: int = 3) -> DataFrame:
    """The first ``count`` distinct paths in order."""
    return archive_paths(lines, partition).orderBy("path").limit(count)


def lines_with_prefix(lines: DataFrame, picks: DataFrame) -> DataFrame:
    """Lines that start with one of the picked paths, however many there are.

    A line offers its beginnings of the lengths that picks have, as keys of one
    semi-join. A pick that starts with another pick adds nothing and is left out, so
    a line meets one pick at most. Only the distinct lengths reach the driver.
    """
    paths = picks.select("path").where(F.col("path").isNotNull()).distinct()
    lengths = sorted(row[0] for row in paths.select(F.length("path")).distinct().collect())
    if not lengths:
        return lines.limit(0)

    def beginnings(text: str, shorter: bool = False):
        fits = (lambda n: F.length(text) > n) if shorter else (lambda n: F.length(text) >= n)
        every = F.array(*map(F.lit, lengths))
        return F.explode(F.transform(F.filter(every, fits), lambda n: F.substring(text, F.lit(1), n)))

    keys = paths.select(F.col("path").alias("_key"))
    longer = paths.select("path", beginnings("path", shorter=True).alias("_key")).join(keys, "_key", "left_semi")
    least = paths.join(longer.select("path"), "path", "left_anti").select(F.col("path").alias("_key"))
    return lines.withColumn("_key", beginnings("value")).join(least, "_key", "left_semi").select(*lines.columns)
