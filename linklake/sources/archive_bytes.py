"""Per-record helper run inside tasks: archive bytes to record tuples.

Reading is streaming: one compressed block and one record are held at a time,
however big the archive is.
"""

from __future__ import annotations

import io
import re
import sys
import zlib
from collections.abc import Iterator

from pyspark import cloudpickle

# Ship this module's functions with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 20
# Stored bytes handed to a decompressor at a time: what a member's end leaves of them is copied.
FEED = 16 << 10
MEMBER_MAGIC = b"\x1f\x8b\x08"
# The most bytes deflate can store as they are in one piece.
STORED_LIMIT = 65_535
CHAIN_BLOCK = 2 * (STORED_LIMIT + 1)  # read at a time to test a chain
WITH_HTTP_BLOCK = ("response", "request", "revisit")


class ArchiveError(Exception):
    """The bytes are not a readable archive from here on."""


def open_at(uri: str, offset: int = -1, length: int = -1):
    """Open a local, http(s) or cluster-storage path, at a byte range if given.

    The range counts only when the offset is not negative and the length is
    positive.
    """
    ranged = offset > -1 and length > 0
    if re.match(r"https?://", uri):
        return _open_web(uri, offset, length) if ranged else _asked(uri)
    if _is_local(uri):
        stream = open(_local_path(uri), "rb")
    else:
        store, path = _store(uri)
        stream = store.open_input_file(path)
    if ranged:
        with stream:
            stream.seek(offset)
            return io.BytesIO(stream.read(length))
    return stream


def _is_local(uri: str) -> bool:
    return uri.startswith("file:") or not re.match(r"[a-z][a-z0-9+.-]*:", uri)


def _local_path(uri: str) -> str:
    from urllib.parse import unquote

    return unquote(re.sub(r"^file:(//[^/]*)?", "", uri)) if uri.startswith("file:") else uri


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _asked(uri: str, method: str = "GET", **headers: str):
    from urllib.request import Request, urlopen

    return urlopen(Request(uri, headers=headers, method=method), timeout=60)


def _open_web(uri: str, offset: int, length: int):
    """A byte range of a web resource. A server may ignore the range and send the whole
    file, whose first record would be taken for the one asked for: that is an error."""
    answer = _asked(uri, Range=f"bytes={offset}-{offset + length - 1}")
    place = re.match(r"bytes (\d+)-(\d+)/", answer.headers.get("Content-Range") or "")
    if answer.status != 206 or not place or int(place[1]) != offset or int(place[2]) >= offset + length:
        answer.close()
        raise OSError(f"no byte range: status {answer.status}, range {answer.headers.get('Content-Range')}")
    return answer


def read_range(uri: str, offset: int, length: int) -> bytes:
    """The bytes of a range; fewer at the end of the file."""
    from http.client import HTTPException

    try:
        with open_at(uri, offset, length) as stream:
            return stream.read()
    except HTTPException as problem:
        raise OSError(f"{type(problem).__name__}: {problem}") from None


def size_of(uri: str) -> int | None:
    """Bytes of an archive, None if it cannot be told."""
    import os

    try:
        if re.match(r"https?://", uri):
            with _asked(uri, method="HEAD") as answer:
                size = answer.headers.get("Content-Length")
                return int(size) if size else None
        if _is_local(uri):
            return os.path.getsize(_local_path(uri))
        store, path = _store(uri)
        return store.get_file_info(path).size
    except (OSError, ValueError):
        return None


# Ranges with no more between them are read together, up to so many bytes.
JOIN_GAP = 256 << 10
JOIN_BYTES = 16 << 20


def joined_ranges(places, gap: int = JOIN_GAP, most: int = JOIN_BYTES):
    """Neighbouring ranges of a file as one request each.

    ``places``: (file, offset, length, row), sorted by file and offset. Gives (file, start,
    length, [((offset, length), row)]) with start -1 for a place without a range, which
    stands for the whole file. A range longer than ``most`` is a request of its own.
    """
    path, start, end, group = None, 0, 0, []
    for file, offset, length, row in places:
        ranged = offset > -1 and length > 0
        joins = ranged and group and file == path and offset <= end + gap and max(end, offset + length) - start <= most
        if group and not joins:
            yield path, start, end - start, group
            group = []
        if not ranged:
            yield file, -1, -1, [((offset, length), row)]
        elif group:
            end = max(end, offset + length)
            group.append(((offset, length), row))
        else:
            path, start, end, group = file, offset, offset + length, [((offset, length), row)]
    if group:
        yield path, start, end - start, group


class _Unpacked:
    """Unpacked bytes of a stream of gzip members (or of a plain stream)."""

    def __init__(self, raw, position: int = 0):
        self.raw, self.position = raw, position
        self.block, self.at = memoryview(b""), 0
        self.buffer, self.member, self.member_start = bytearray(), None, 0
        self.gzipped, self.members_done = None, 0

    def _feed(self, most: int = FEED) -> memoryview:
        """Stored bytes that come next; none at the end."""
        if self.at == len(self.block):
            self.block, self.at = memoryview(self.raw.read(BLOCK)), 0
        return self.block[self.at : self.at + most]

    def _taken(self, size: int) -> None:
        self.at += size
        self.position += size

    def pull(self) -> bool:
        """Unpack some more; False at the end of the current member or stream."""
        if self.gzipped is None:
            fed = self._feed()
            if not fed:
                return False
            self.gzipped = fed[:2] == b"\x1f\x8b"
        if not self.gzipped:
            fed = self._feed(BLOCK)
            if not fed:
                return False
            self.buffer += fed
            self._taken(len(fed))
            return True
        while self.member is not None:
            fed = self._feed()
            try:
                unpacked = self.member.decompress(fed, 4 * BLOCK)
            except zlib.error as problem:
                raise ArchiveError(f"bad gzip data: {problem}") from None
            ended = self.member.eof
            if not (fed or unpacked or ended):
                raise ArchiveError("gzip member is cut off")
            self.buffer += unpacked
            self._taken(len(fed) - len(self.member.unused_data if ended else self.member.unconsumed_tail))
            if ended:
                self.member, self.members_done = None, self.members_done + 1
                return bool(self.buffer)
            if self.buffer:
                return True
        return False

    def start_record(self) -> int | None:
        """Skip blank lines; offset of the next record, None at the end."""
        while True:
            while self.buffer and self.buffer[0] in b"\r\n":
                del self.buffer[0]
            if self.buffer:
                if self.gzipped:
                    return self.member_start
                return self.position - len(self.buffer)
            if self.gzipped and self.member is None:
                fed = self._feed()
                if not fed:
                    return None
                if fed[:1] != b"\x1f":
                    raise ArchiveError("no gzip member where one should start")
                self.member_start = self.position
                self.member = zlib.decompressobj(31)
            if not self.pull() and (self.member is not None or not self.gzipped):
                return None

    def line(self) -> bytes:
        seen = 0
        while True:
            end = self.buffer.find(b"\n", seen)
            if end >= 0:
                break
            seen = len(self.buffer)
            if not self.pull():
                end = len(self.buffer) - 1
                break
        found = bytes(self.buffer[: end + 1])
        del self.buffer[: end + 1]
        return found

    def exactly(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self.pull():
                raise ArchiveError("record content is cut off")
        found = bytes(self.buffer[:size])
        del self.buffer[:size]
        return found

    def end_record(self, start: int) -> int:
        """Stored length of the record that began at ``start``; -1 if it shares
        its gzip member with others."""
        while True:
            while self.buffer and self.buffer[0] in b"\r\n":
                del self.buffer[0]
            if self.buffer or not self.pull():
                break
        if not self.gzipped:
            return self.position - len(self.buffer) - start
        if self.buffer or self.member is not None:
            self.shared = self.member_start
            return -1
        return -1 if getattr(self, "shared", None) == start else self.position - start


def _text(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _headers(lines: Iterator[bytes]) -> dict[str, str]:
    """Header lines up to a blank one; the first of a repeated name is kept."""
    found, last = {}, None
    for raw in lines:
        text = _text(raw).rstrip("\r\n")
        if not text:
            break
        if text[0] in " \t":
            if last is not None:
                found[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        last = name.strip().lower() if colon and name.strip().lower() not in found else None
        if last is not None:
            found[last] = value.strip()
    return found


def _dechunk(body: bytes) -> bytes:
    """Undo chunked transfer; bytes that are not chunked are kept as they are."""
    out, at = [], 0
    while at < len(body):
        end = body.find(b"\r\n", at)
        size = re.match(rb"\s*([0-9a-fA-F]+)\s*(?:;.*)?\Z", body[at:end]) if end >= 0 else None
        if size is None:
            out.append(body[at:])
            break
        count = int(size.group(1), 16)
        if count == 0:
            break
        out.append(body[end + 2 : end + 2 + count])
        at = end + 2 + count
        if body[at : at + 2] == b"\r\n":
            at += 2
    return b"".join(out)


def _decode_body(body: bytes, http: dict[str, str]) -> bytes:
    if http.get("transfer-encoding", "").lower() == "chunked":
        body = _dechunk(body)
    wanted = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}
    for bits in wanted.get(http.get("content-encoding", "").lower(), ()):
        try:
            return zlib.decompressobj(bits).decompress(body)
        except zlib.error:
            continue
    return body


def _split_http(content: bytes) -> tuple[dict[str, str] | None, bytes]:
    """HTTP headers and body of a record; None when it has no header block."""
    if not re.match(rb"(?:HTTP/|[A-Z]+ \S+ HTTP/)", content):
        return None, content
    stream = io.BytesIO(content)
    stream.readline()
    http = _headers(iter(stream.readline, b""))
    return http, stream.read()


def _warc_record(source: _Unpacked):
    version = source.line()
    if version.startswith(b"WARC/"):
        headers = _headers(iter(source.line, b""))
        try:
            size = int(headers["content-length"])
        except (KeyError, ValueError):
            raise ArchiveError("record has no content length") from None
        target = headers.get("warc-target-uri", "")
        if target.startswith("<") and target.endswith(">"):  # as some writers put it
            headers["warc-target-uri"] = target[1:-1]
        return headers, source.exactly(size)
    # The older format: one line of blank-separated fields, the length last.
    fields = _text(version).split()
    if len(fields) < 5 or not fields[-1].isdigit() or ":" not in fields[0]:
        raise ArchiveError(f"unknown record start {version[:40]!r}")
    kind = "warcinfo" if fields[0].startswith("filedesc://") else "response"
    headers = {
        "warc-type": kind,
        "warc-target-uri": fields[0],
        "warc-ip-address": fields[1],
        "warc-date": fields[2],
        "content-type": "application/http; msgtype=response" if kind == "response" else fields[3],
        "content-length": fields[-1],
    }
    return headers, source.exactly(int(fields[-1]))


def is_chain_start(stream, at: int) -> bool:
    """Whole record members follow one another from ``at`` on, for longer than
    deflate can store bytes unchanged or to the end of the file.

    Members of an archive that is itself the content of a record can look the
    same, but only inside one stored piece, so they never pass.
    """
    stream.seek(at)
    position, block = at, memoryview(b"")
    while True:
        inflater, head = zlib.decompressobj(31), b""
        while not inflater.eof:
            block = block or memoryview(stream.read(CHAIN_BLOCK))
            if not block:
                return False
            fed = block[:FEED]
            try:
                out = inflater.decompress(fed, BLOCK)
            except zlib.error:
                return False
            taken = len(fed) - len(inflater.unused_data if inflater.eof else inflater.unconsumed_tail)
            block, position = block[taken:], position + taken
            head = (head + out[:5])[:5]
            if not b"WARC/".startswith(head):
                return False
        if head != b"WARC/":
            return False
        block = block or memoryview(stream.read(CHAIN_BLOCK))
        if not block or position - at > STORED_LIMIT:
            return True


def find_chain_start(stream, start: int, end: int) -> int | None:
    """First offset in the range where a chain of record members starts."""
    if start == 0:
        return 0
    at, kept = start, b""
    while at < end:
        stream.seek(at + len(kept))
        fresh = stream.read(min(BLOCK, end + len(MEMBER_MAGIC) - 1 - at - len(kept)))
        block = kept + fresh
        found = block.find(MEMBER_MAGIC)
        while found >= 0 and at + found < end:
            if is_chain_start(stream, at + found):
                return at + found
            found = block.find(MEMBER_MAGIC, found + 1)
        if not fresh:
            return None
        kept = block[-2:]
        at += len(block) - len(kept)
    return None


def split_stretch(uri: str, number: int, start: int, end: int, parse_http: bool = True, rec_types=None):
    """Records of one byte stretch of an archive.

    A stretch owns the members from its first chain start up to the first chain
    start past its end, so every record belongs to exactly one stretch. An archive
    that is not made of record members is left whole to stretch 0. Positions rise
    in file order but are not dense.
    """
    with open_at(uri) as stream, open_at(uri) as probe:
        first = find_chain_start(probe, start, end)
        if first is None:
            return
        stream.seek(first)

        def is_next(offset: int) -> bool:
            return offset >= end and is_chain_start(probe, offset)

        yield from split_records(stream, parse_http, rec_types, first, number << 32, is_next)


def split_records(
    stream, parse_http: bool = True, rec_types=None, start: int = 0, position: int = 0, stop_at=None
) -> Iterator[tuple]:
    """Tuples in ``schemas.RECORD`` order; a last one with an error if the
    archive cannot be read to its end."""
    source = _Unpacked(stream, start)
    try:
        while (offset := source.start_record()) is not None:
            if stop_at is not None and stop_at(offset):
                return
            headers, content = _warc_record(source)
            length = source.end_record(offset)
            kind = headers.get("warc-type")
            if rec_types is None or kind in rec_types:
                http, payload = None, content
                if parse_http and kind in WITH_HTTP_BLOCK:
                    http, payload = _split_http(content)
                    payload = _decode_body(payload, http) if http else payload
                yield (
                    position, offset, length, kind, headers.get("content-type"),
                    headers.get("warc-target-uri"), headers, http, payload, None,
                )
            position += 1
    except (ArchiveError, OSError) as problem:
        yield failure(problem, position)


def failure(problem: Exception, position: int = 0) -> tuple:
    message = f"{type(problem).__name__}: {problem}"
    return (position, None, None, None, None, None, None, None, None, message)
