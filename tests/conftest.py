import gzip
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "checkpoints"))
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def column(spark, values, expression, kind="string"):
    """Results of an expression over column ``v``, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[1] for r in sorted(rows.select("i", expression).collect())]


def warc_head(kind, uri, content_type, size, extra=""):
    return (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n{extra}"
        f"Content-Type: {content_type}\r\nContent-Length: {size}\r\n\r\n"
    ).encode()


def record(kind, uri, body, content_type="application/http; msgtype=response", extra=""):
    return warc_head(kind, uri, content_type, len(body), extra) + body + b"\r\n\r\n"


def page(html, content_type="text/html", headers=""):
    return f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\n{headers}\r\n".encode() + html


def archive(path, *records):
    """Write one gzip member a record; (offset, length) of each."""
    places, data = [], b""
    for raw in records:
        member = gzip.compress(raw, mtime=0)
        places.append((len(data), len(member)))
        data += member
    Path(path).write_bytes(data)
    return places
