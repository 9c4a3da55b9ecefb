"""Link tables, URL index tables and coordinate tables."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linklake import schemas

LINK_TABLE = "external_links"
INDEX_VIEW = "ccindex"


def split_options(pairs: Iterable[str]) -> dict[str, str]:
    """``name=value`` texts as a dict; the value may hold more ``=``."""
    return dict(pair.split("=", 1) for pair in pairs)


def read_links(spark: SparkSession, table: str = LINK_TABLE) -> DataFrame:
    """The link column of the link table; nothing else is read."""
    return spark.table(table).select("link")


def read_links_jdbc(spark: SparkSession, url: str, table: str = LINK_TABLE, **options: str) -> DataFrame:
    """The link column of a table in a database.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    to read it in parallel by its id.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.load().select("link")


def read_link_files(spark: SparkSession, path: str) -> DataFrame:
    """Links of link files: one column, comma-separated, doubled quotes.

    Blank lines are dropped, a quoted empty text is kept. A line with a second
    column stops the read rather than being cut.
    """
    # NUL stands for null: no link holds one, while an empty text is a value here.
    reader = spark.read.schema(schemas.LINK).options(
        sep=",", quote='"', escape='"', mode="FAILFAST", encoding="UTF-8", nullValue="\x00", emptyValue=""
    )
    links = reader.csv(path)
    return links.where(links.link.isNotNull())


def load_index(
    spark: SparkSession, path: str, view: str = INDEX_VIEW, schema_file: str | None = None
) -> DataFrame:
    """A columnar URL index, also registered as a temporary view.

    The schema comes from a JSON file if one is given, else from the files.
    """
    reader = spark.read
    if schema_file is not None:
        text = spark.read.text(schema_file, wholetext=True).first()[0]
        reader = reader.schema(StructType.fromJson(json.loads(text)))
    index = reader.parquet(path)
    index.createOrReplaceTempView(view)
    return index


def read_coordinates_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_coordinates(
    spark: SparkSession, path: str, table_format: str, options: Iterable[str] = ()
) -> DataFrame:
    """A coordinate table in any format, with ``name=value`` reader options."""
    return spark.read.format(table_format).options(**split_options(options)).load(path)
