"""Archive files written from the pages, to be read back by the library.

Each task writes one archive under the shared working folder and hands back the
coordinates of its records, which make the URL index.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from linklake.session import bound_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_INDEX = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("warc_filename", pa.string()),
        ("warc_record_offset", pa.int64()), ("warc_record_length", pa.int64()),
        ("content_charset", pa.string()),
    ]
)
_INDEX_DDL = (
    "page_id bigint, url string, warc_filename string, warc_record_offset bigint, "
    "warc_record_length bigint, content_charset string"
)


def warc_member(kind: str, url: str, content_type: str, body: bytes) -> bytes:
    """One gzipped record."""
    import gzip

    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\n"
        f"Content-Type: {content_type}\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + body + b"\r\n\r\n", mtime=0)


def http_response(body: bytes, content_type: str = "text/html; charset=utf-8") -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: " + content_type.encode() + b"\r\n\r\n" + body


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html`` rows as archives; the stored URL index."""

    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(f"{base}/archives")
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.warc.gz"
        draft = f"{base}/archives/.{name}.{task.taskAttemptId()}"
        offset, rows = 0, 0
        with store.open_output_stream(draft, compression=None) as out:
            intro = warc_member("warcinfo", "", "application/warc-fields", b"format: WARC\r\n")
            out.write(intro)
            offset += len(intro)
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    request = warc_member(
                        "request", row["url"], "application/http; msgtype=request",
                        b"GET / HTTP/1.1\r\nHost: x\r\n\r\n",
                    )
                    response = warc_member(
                        "response", row["url"], "application/http; msgtype=response",
                        http_response(row["html"].encode()),
                    )
                    out.write(request)
                    out.write(response)
                    offset += len(request)
                    found.append((row["page_id"], row["url"], name, offset, len(response), "UTF-8"))
                    offset += len(response)
                rows += len(found)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(zip(*found), _INDEX)], schema=_INDEX
                    )
        if rows:
            store.move(draft, f"{base}/archives/{name}")
        else:
            store.delete_file(draft)

    bound_batches(pages.sparkSession)
    spread = pages.select("page_id", "url", "html").repartition("page_id")
    index = spread.sortWithinPartitions("page_id").mapInArrow(write, _INDEX_DDL)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(_INDEX_DDL).parquet(f"{folder}/index")
