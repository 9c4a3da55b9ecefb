"""Schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(), "long": LongType(), "int": IntegerType(), "boolean": BooleanType(),
    "double": DoubleType(), "binary": BinaryType(), "timestamp": TimestampType(),
    "headers": MapType(StringType(), StringType()), "strings": ArrayType(StringType()),
}


def columns(text: str) -> StructType:
    """A schema from ``name kind, name kind``; unlike DDL it needs no session."""
    pairs = [column.split() for column in text.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


LINK = columns("link string")
KEY_VALUE = columns("key string, val long")
AD_HOSTS = columns("host string")
CATEGORIES = ArrayType(columns("confidence double, id int, name string"))
CATEGORY_REPLY = StructType([StructField("categories", CATEGORIES)])
BINARY_FILE = columns("path string, modificationTime timestamp, length long, content binary")
COORDINATES = ["url", "warc_filename", "warc_record_offset", "warc_record_length"]
CHARSET_COLUMN = "content_charset"
# Headers have lower-case keys; ``length`` is -1 where a record has no gzip
# member of its own; ``error`` is set on rows that stand for an unreadable
# archive or record, and all record columns are null there.
RECORD = columns(
    "record_pos long, offset long, length long, rec_type string, content_type string, "
    "target_uri string, warc_headers headers, http_headers headers, payload binary, error string"
)
SITE = columns(
    "primary_link string, part int, frequency long, subsections strings, "
    "country_code string, category string, is_ad_domain boolean"
)
