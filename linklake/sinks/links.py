"""Link files and the link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake import storage
from linklake.functions.text import clean_link, has_clean_text
from linklake.sources.tables import LINK_TABLE

IDS_A_LOAD = 1 << 40  # ids set aside for a load


def link_line(link: Column) -> Column:
    """A link as its line in a link file: quoted when it holds a comma."""
    quoted = F.concat(F.lit('"'), link, F.lit('"'))
    return F.when(F.contains(link, F.lit(",")), quoted).otherwise(link)


def write_link_files(links: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Cleaned, non-empty links as text, one file a task.

    Readers take the folder, so no step merges the parts into one file.
    """
    kept = links.where(has_clean_text(F.col("link")))
    cleaned = kept.select(clean_link(F.col("link")).alias("link"))
    cleaned.select(link_line(F.col("link")).alias("value")).write.mode(mode).text(path)


def merge_link_files(spark: SparkSession, *paths: str) -> DataFrame:
    """All lines of several link folders as one frame."""
    return spark.read.text(list(paths))


def create_link_table(spark: SparkSession, table: str = LINK_TABLE, location: str | None = None) -> None:
    """The link table, in the warehouse or at a location, if it is missing."""
    place = f" LOCATION '{location}'" if location else ""
    columns = "(id BIGINT, link STRING NOT NULL)"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} {columns} USING parquet{place}")


def _location(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return found["data_type"].rstrip("/")


def _load_number(spark: SparkSession, location: str) -> int:
    """A number that no other load of the table has, from empty files beside the table.

    The next free one is claimed by making its file, which one of several loads achieves.
    """
    taken = storage.names(spark, f"{location}-loads")
    number = int(taken[-1]) + 1 if taken else 1
    while not storage.claim(spark, f"{location}-loads/{number:09d}"):
        number += 1
    return number


def append_links(links: DataFrame, table: str = LINK_TABLE) -> None:
    """Append the non-null links to the link table, made if it is missing.

    A load has a range of ids of its own, ``IDS_A_LOAD`` from its number on, so loads at the same
    time never share an id and no load looks at the rows of others. Inside it ids
    are dense: rows are staged once with their place in a partition, and the sizes of the partitions
    before do the rest. A load is written whole beside the table and its files are then moved in:
    writers that append to one folder at a time would clear each other's unfinished files away.
    """
    spark = links.sparkSession
    create_link_table(spark, table)
    kept = links.where(F.col("link").isNotNull()).select("link")
    staged = storage.written(kept.select("link", F.monotonically_increasing_id().alias("place")), "staged-links")
    part, inside = F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    location = _location(spark, table)
    load = _load_number(spark, location)
    offsets, first = [], load * IDS_A_LOAD
    for number, size in sorted(map(tuple, staged.groupBy(part).count().collect())):  # a row a partition
        offsets.append((number, first))
        first += size
    before = F.broadcast(spark.createDataFrame(offsets, "part bigint, before bigint"))
    rows = staged.withColumn("part", part).join(before, "part")
    rows = rows.select((F.col("before") + inside).alias("id"), "link")
    rows.write.parquet(f"{location}-staged/{load:09d}")
    storage.move_files(spark, f"{location}-staged/{load:09d}", location)
    spark.catalog.refreshTable(table)
