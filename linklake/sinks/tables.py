"""Site data set, metric tables and generic table output."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from linklake.sources.tables import split_options

SITE_PARTITIONS = ("country_code", "category")


def write_sites(sites: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Sites as Parquet, partitioned by country and category.

    Rebalancing by the partition columns gives each folder few files, and
    adaptive execution cuts a folder that holds much of the rows into several.
    """
    spread = sites.hint("rebalance", *SITE_PARTITIONS)
    spread.write.mode(mode).partitionBy(*SITE_PARTITIONS).parquet(path)


def write_metrics(metrics: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """One Parquet data set a metric, named by the metric."""
    for name, table in metrics.items():
        table.write.mode(mode).parquet(f"{folder}/{name}.parquet")


def compression_for(table_format: str, compression: str) -> str:
    return "zlib" if (table_format, compression) == ("orc", "gzip") else compression


def in_files(table: DataFrame, files: int, shuffle: bool = True) -> DataFrame:
    """The table in ``files`` partitions.

    Shuffling keeps the work before it as parallel as it was; without it the
    tasks of the last stage are merged, which suits small results.
    """
    return table.repartition(files) if shuffle else table.coalesce(files)


def save_table(
    table: DataFrame,
    name: str,
    table_format: str = "parquet",
    compression: str = "gzip",
    options: Iterable[str] = (),
    files: int | None = None,
    shuffle: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Save as a catalog table; ``files=None`` leaves file sizes to Spark."""
    shaped = table.hint("rebalance") if files is None else in_files(table, files, shuffle)
    writer = shaped.write.format(table_format).mode(mode)
    writer = writer.option("compression", compression_for(table_format, compression))
    writer.options(**split_options(options)).saveAsTable(name)
