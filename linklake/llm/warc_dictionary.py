"""WARC archives compressed record by record with a Zstandard dictionary of their own.

A task writes what it gets as archives of bounded size. For each it trains a dictionary on
records it is about to write, puts that into a leading skippable frame (its magic number is
the one readers of dictionary-compressed WARC files look for), and adds every record as a
frame of its own, so any record can be read knowing only its offset and the first frame.

Records with equal payloads are written once: the smallest page id is the response, the
others are revisits that name it. Payloads under ``least`` bytes are always responses.

A writing task hands back the archives it closed; readers take that list, so files of
failed attempts are never read. Names hold the attempt, so attempts do not meet.

Edge cases: rows without an id share the id null, which counts as the smallest; null payloads are empty; a null address gives no target header; rows that share
the smallest id of a payload are all responses; an empty table gives no archive and no
record; records that cannot be trained on give a dictionary of their
plain content, fewer than 8 none; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import ids, ids_back, stored
from linklake.session import work_folder

# The skippable frame of a WARC dictionary, the profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
LEAST_PAYLOAD = 100
ARCHIVE_BYTES = 64 << 20  # an archive is closed once it is this long
TRAINING_BYTES = 2 << 20  # of records, at the head of an archive
DICTIONARY_BYTES = 64 << 10
RECORD = "page_id long, record_type string, refers_to long, target_uri string, payload_bytes long, payload_digest string, payload binary"
MANIFEST = "path string, records long, bytes long"


def record_bytes(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record; a revisit has the HTTP head only."""
    head = HTTP_HEAD % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples)
    except zstandard.ZstdError:  # too few or too like: plain record content serves as one
        raw = b"".join(samples)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(samples) > 7 else None


def _located(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class _Archive:
    """An archive under way: records wait until there are enough to train on."""

    def __init__(self, uri: str):
        self.uri, self.waiting, self.held, self.records, self.size = uri, [], 0, 0, 0
        self.out = self.compressor = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.out is not None:
            self._put(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= TRAINING_BYTES:
            self._begin()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _begin(self) -> None:
        files, path = _located(self.uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)
        learned = trained_dictionary(self.waiting)
        if learned is not None:
            raw = learned.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=learned, write_content_size=True)
        for record in self.waiting:
            self._put(self.compressor.compress(record))
        self.waiting = []

    def closed(self) -> tuple[str, int, int]:
        if self.out is None:
            self._begin()
        self.out.close()
        return self.uri, self.records, self.size


def _written(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context, archive, serial = TaskContext.get(), None, 0
        stem = f"{folder.rstrip('/')}/{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        for batch in batches:
            done = []
            for page, url, payload, digest, refers in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                if archive is None:
                    archive, serial = _Archive(f"{stem}-{serial:05d}.warc.zst"), serial + 1
                archive.add(record_bytes(page, url, payload, digest, None if pd.isna(refers) else int(refers), date))
                if archive.size >= archive_bytes:
                    done.append(archive.closed())
                    archive = None
            if done:
                yield pd.DataFrame(done, columns=["path", "records", "bytes"])
        if archive is not None:
            yield pd.DataFrame([archive.closed()], columns=["path", "records", "bytes"])

    return run


def deduplicated(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_PAYLOAD) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(ids(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Digests and ids alone are shuffled to find the first page; partial minima come first.
    long_enough = rows.where(F.length("payload") >= least)
    first = long_enough.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(first.select("digest", "first"), "digest", "left")
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to")
    )


def write_archives(records: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write what ``deduplicated`` gave; the table of closed archives."""
    return stored(records.mapInPandas(_written(folder, date, archive_bytes), MANIFEST), "archives")


def _parsed(raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    kind = fields["WARC-Type"]

    def page(value: str) -> int:
        return int(value.removeprefix("<urn:page:").removesuffix(">"))

    if kind == "revisit":
        size, digest, refers, payload = int(fields["Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), page(fields["WARC-Refers-To"]), None
    else:
        size, digest, refers = len(payload), hashlib.sha256(payload).hexdigest(), None
    return page(fields["WARC-Record-ID"]), kind, refers, fields.get("WARC-Target-URI"), size, digest, payload


def archive_records(stream) -> Iterator[bytes]:
    """Uncompressed records of an open archive, frame by frame."""
    held, learned = b"", None
    while True:
        more = stream.read(1 << 20)
        held += more
        if len(held) >= 8 and learned is None:
            magic, size = struct.unpack("<II", held[:8])
            if magic == DICTIONARY_MAGIC:
                held += stream.read(max(0, 8 + size - len(held)))
                learned, held = zstandard.ZstdCompressionDict(held[8 : 8 + size]), held[8 + size :]
            else:
                learned = False
        while held:
            reader = zstandard.ZstdDecompressor(dict_data=learned or None).decompressobj()
            record = reader.decompress(held)
            if not reader.eof:
                break
            yield record
            held = reader.unused_data
        if not more:
            if held:
                raise ValueError("the archive ends inside a record")
            return


def _read(payloads: bool):
    names = [part.split()[0] for part in RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                files, path = _located(uri)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for raw in archive_records(stream):
                        row = _parsed(raw)
                        size += len(raw)
                        rows.append(row if payloads else (*row[:-1], None))
                        if size >= 8 << 20:
                            yield _frame(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _frame(rows, names)

    return run


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.assign(refers_to=frame["refers_to"].astype("Int64"))


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives of a manifest; a task an archive."""
    spread = manifest.repartition(max(1, manifest.count()))
    records = spread.mapInPandas(_read(payloads), RECORD)
    return records.withColumns({c: ids_back(F.col(c)) for c in ("page_id", "refers_to")})


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write a record a page, read the archives back; what each record says of its payload."""
    folder = work_folder(pages.sparkSession, "warc")
    manifest = write_archives(deduplicated(pages), folder)
    return read_archives(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
