import gzip
import io
import zlib
from pathlib import Path

import pytest
from conftest import archive, page, record
from pyspark.sql import functions as F

from linklake.operators.anchors import page_anchors, page_links
from linklake.sources import archive_bytes, archives


def split(data, **options):
    return list(archive_bytes.split_records(io.BytesIO(data), **options))


def test_records_keep_order_place_and_headers(tmp_path):
    raws = [
        record("warcinfo", "", b"format: x\r\n", "application/warc-fields"),
        record("response", "http://a.com/", page(b"<p>", headers="X: 1\r\nX: 2\r\n fold\r\n"), extra="Foo: Bar\r\n"),
        record("response", "http://b.com/", b"no header block", "text/plain"),
    ]
    places = archive(tmp_path / "x.warc.gz", *raws)
    got = split((tmp_path / "x.warc.gz").read_bytes())
    assert [(r[1], r[2]) for r in got] == places and [r[0] for r in got] == [0, 1, 2]
    assert got[1][6]["foo"] == "Bar" and got[1][7] == {"content-type": "text/html", "x": "1"}
    assert got[1][8] == b"<p>" and got[2][7] is None and got[2][8] == b"no header block"
    only = split((tmp_path / "x.warc.gz").read_bytes(), rec_types=("response",))
    assert [r[0] for r in only] == [1, 2]
    raw = split((tmp_path / "x.warc.gz").read_bytes(), parse_http=False)
    assert raw[1][7] is None and raw[1][8].startswith(b"HTTP/1.1")


def test_plain_and_shared_member_archives():
    raws = [record("response", f"http://{i}.com/", page(b"x" * i)) for i in range(4)]
    plain = split(b"".join(raws))
    assert [r[5] for r in plain] == [f"http://{i}.com/" for i in range(4)]
    assert [r[1] for r in plain] == [sum(map(len, raws[:i])) for i in range(4)]
    assert [r[2] for r in plain] == [len(r) for r in raws]
    shared = split(gzip.compress(b"".join(raws)))
    assert [len(r[8]) for r in shared] == [0, 1, 2, 3] and {r[2] for r in shared} == {-1}


def test_big_record_crosses_blocks():
    body = bytes(range(256)) * 40_000
    got = split(gzip.compress(record("response", "http://a.com/", page(body))) * 2)
    assert [r[8] == body for r in got] == [True, True]


def test_older_format():
    body = page(b"hi")
    head = b"filedesc://x.arc 0.0.0.0 20250101000000 text/plain 3\n1 0\n\n"
    entry = f"http://a.com/ 1.2.3.4 20250101000000 text/html {len(body)}\n".encode() + body + b"\n"
    got = split(gzip.compress(head) + gzip.compress(entry))
    assert [(r[3], r[5]) for r in got] == [("warcinfo", "filedesc://x.arc"), ("response", "http://a.com/")]
    assert got[1][8] == b"hi" and got[1][7] == {"content-type": "text/html"}


@pytest.mark.parametrize("coding", ["gzip", "deflate", "raw", "none"])
def test_bodies_are_decoded(coding):
    raw = zlib.compressobj(wbits=-15)
    packed = {"gzip": gzip.compress(b"hello"), "deflate": zlib.compress(b"hello"),
              "raw": raw.compress(b"hello") + raw.flush(), "none": b"hello"}[coding]
    chunked = b"3\r\n" + packed[:3] + b"\r\n" + f"{len(packed) - 3:x}".encode() + b"\r\n" + packed[3:] + b"\r\n0\r\n\r\n"
    name = {"raw": "deflate", "none": "identity"}.get(coding, coding)
    headers = f"Transfer-Encoding: chunked\r\nContent-Encoding: {name}\r\n"
    assert split(record("response", "http://a/", page(chunked, headers=headers)))[0][8] == b"hello"


def test_body_that_is_not_chunked_is_kept():
    got = split(record("response", "http://a/", page(b"<p>plain", headers="Transfer-Encoding: chunked\r\n")))
    assert got[0][8] == b"<p>plain"


def test_damage_gives_an_error_row(spark, tmp_path):
    good = record("response", "http://a.com/", page(b"<p>"))
    archive(tmp_path / "good.warc.gz", good, good)
    data = gzip.compress(good) + gzip.compress(record("response", "http://b.com/", page(b"y" * 500)))
    (tmp_path / "cut.warc.gz").write_bytes(data[:-20])
    (tmp_path / "junk.warc.gz").write_bytes(b"not an archive\n")
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    (tmp_path / "other.txt").write_text("x")
    paths = archives.list_archives(spark, str(tmp_path))
    missing = spark.createDataFrame([(str(tmp_path / "missing.warc.gz"),)], "warc_file string")
    records = archives.read_records(paths.select("warc_file").unionAll(missing), partitions=3)
    name = F.regexp_extract("warc_file", r"([a-z]+)\.warc", 1)
    got = records.groupBy(name.alias("n")).agg(
        F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("bad")
    )
    assert {tuple(r) for r in got.collect()} == {("good", 2, 0), ("cut", 1, 1), ("junk", 0, 1), ("missing", 0, 1)}
    assert records.where("error is null and payload is null").count() == 0


def test_payload_can_be_left_out(spark, tmp_path):
    archive(tmp_path / "a.warc.gz", record("response", "http://a.com/", page(b"<p>")))
    records = archives.read_records(archives.list_archives(spark, str(tmp_path)), with_payload=False)
    assert [(r.target_uri, r.payload) for r in records.collect()] == [("http://a.com/", None)]


def test_fetch_by_coordinates(spark, tmp_path):
    raws = [record("response", f"http://{i}.com/", page(f"<p>{i}".encode())) for i in range(6)]
    places = archive(tmp_path / "a.warc.gz", *raws)
    rows = [(f"http://{i}.com/", "a.warc.gz", str(o), str(n), "latin-1" if i else None) for i, (o, n) in enumerate(places)]
    rows.append(("whole", "a.warc.gz", "-1", "0", None))
    rows.append(("lost", "b.warc.gz", "0", "9", None))
    schema = "url string, warc_filename string, warc_record_offset string, warc_record_length string, content_charset string"
    table = spark.createDataFrame(rows, schema)
    got = archives.fetch_records(table, base_uri=f"file://{tmp_path}/", partitions=3).collect()
    single = sorted((r.url, r.target_uri, r.offset) for r in got if r.url.startswith("http"))
    assert single == sorted((f"http://{i}.com/", f"http://{i}.com/", places[i][0]) for i in range(6))
    assert len([r for r in got if r.url == "whole"]) == 6
    assert [r.error is not None for r in got if r.url == "lost"] == [True]
    hint = "warc-identified-content-charset"
    assert {r.url: r.warc_headers.get(hint) for r in got if r.url in ("http://0.com/", "http://1.com/")} == {
        "http://0.com/": None, "http://1.com/": "latin-1"
    }


def test_paths(spark, tmp_path):
    paths = spark.createDataFrame([("s3://b/k",), ("a/b",), ("/abs",), ("https://x/y",), ("hdfs:/z",)], "p string")

    def resolved(**bases):
        return [r[0] for r in paths.select(archives.resolve_path(F.col("p"), **bases)).collect()]

    assert resolved() == ["s3://b/k", "a/b", "/abs", "https://x/y", "hdfs:/z"]
    assert resolved(base_uri="s3://c/")[1:3] == ["s3://c/a/b", "s3://c//abs"]
    assert resolved(local_base="/data")[1:3] == ["/data/a/b", "/abs"]
    (tmp_path / "list.txt").write_text("x.warc.gz\n\ns3://b/y.warc.gz\n")
    named = archives.archive_paths(spark, str(tmp_path / "list.txt"), base_uri="s3://c/")
    assert [r[0] for r in named.collect()] == ["s3://c/x.warc.gz", "s3://b/y.warc.gz"]


def test_http_ranges(monkeypatch):
    seen = []

    def fake(request, timeout):
        seen.append((request.full_url, request.get_header("Range")))
        answer = io.BytesIO(b"x")
        answer.status, answer.headers = 206, {"Content-Range": "bytes 5-5/6"}
        return answer

    monkeypatch.setattr("urllib.request.urlopen", fake)
    archive_bytes.open_at("https://h/x", 5, 10)
    archive_bytes.open_at("https://h/x", 5, 0)
    assert seen == [("https://h/x", "bytes=5-14"), ("https://h/x", None)]


def test_links_of_records(spark, tmp_path):
    html = b'<a href="http://x.com/a,b">1</a><a href="/r">2</a><a href="https://y.com">\xff</a>'
    archive(
        tmp_path / "a.warc.gz",
        record("request", "http://q.com/", b"GET / HTTP/1.1\r\n\r\n", "application/http; msgtype=request"),
        record("response", "http://p.com/", page(html, "Text/HTML; charset=x")),
        record("response", "http://j.com/", page(html, "application/json")),
        record("response", "http://n.com/", b"no header block"),
    )
    links = page_links(page_anchors(archives.read_records(archives.list_archives(spark, str(tmp_path)))))
    got = [tuple(r) for r in links.select("record_pos", "link_pos", "link").orderBy("record_pos", "link_pos").collect()]
    assert got == [
        (1, 0, "http://p.com/"), (1, 1, "http://x.com/a,b"), (1, 2, "https://y.com"), (2, 0, "http://j.com/"),
        (3, 0, "http://n.com/"),
    ]
    assert Path(tmp_path / "a.warc.gz").exists()


def by_stretches(path, size):
    total = Path(path).stat().st_size
    found = []
    for number in range((total + size - 1) // size):
        found += archive_bytes.split_stretch(str(path), number, number * size, (number + 1) * size)
    return found


def noise(size, seed):
    import random

    return random.Random(seed).randbytes(size)


def test_stretches_cover_an_archive_once(tmp_path):
    """Also with records that hold archives themselves, stored unchanged."""
    members = [gzip.compress(record("response", f"http://inner{i}.com/", page(noise(3000, i)))) for i in range(30)]
    inner = b"".join(members)
    data = b""
    for i in range(60):
        body = inner if i % 7 == 3 else noise(200_000, i) if i % 11 == 5 else noise(i * 40, i)
        raw = record("response", f"http://{i}.com/", page(body))
        data += gzip.compress(raw, compresslevel=0 if i % 7 == 3 else 9)
    assert sum(member in data for member in members) > 20
    (tmp_path / "a.warc.gz").write_bytes(data)
    whole = [r[1:] for r in split((tmp_path / "a.warc.gz").read_bytes())]
    assert len(whole) == 60
    for size in (1_000, 7_777, 50_000, 300_000, 10**9):
        cut = by_stretches(tmp_path / "a.warc.gz", size)
        assert [r[1:] for r in cut] == whole
        assert [r[0] for r in cut] == sorted({r[0] for r in cut})


def test_stretches_of_other_archives(tmp_path):
    raws = [record("response", f"http://{i}.com/", page(noise(500, i))) for i in range(20)]
    (tmp_path / "plain").write_bytes(b"".join(raws))
    (tmp_path / "shared").write_bytes(gzip.compress(b"".join(raws)))
    for name in ("plain", "shared"):
        whole = [r[1:] for r in split((tmp_path / name).read_bytes())]
        assert [r[1:] for r in by_stretches(tmp_path / name, 1000)] == whole and len(whole) == 20


def test_stretches_around_damage(tmp_path):
    raws = [record("response", f"http://{i}.com/", page(noise(4000, i))) for i in range(100)]
    places = archive(tmp_path / "a.warc.gz", *raws)
    data = bytearray((tmp_path / "a.warc.gz").read_bytes())
    data[places[50][0] + 2000] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(data)
    got = by_stretches(tmp_path / "a.warc.gz", 60_000)
    read = [r[5] for r in got if r[-1] is None]
    assert len(read) == len(set(read)) and {f"http://{i}.com/" for i in range(50)} <= set(read)
    assert [r for r in got if r[-1] is not None] and "http://99.com/" in read


def test_cut_archives_follows_sizes(spark, tmp_path):
    raws = [record("response", f"http://{i}.com/", page(noise(500, i))) for i in range(40)]
    archive(tmp_path / "big.warc.gz", *raws)
    archive(tmp_path / "small.warc.gz", raws[0])
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    listed = archives.list_archives(spark, str(tmp_path))
    cut = archives.cut_archives(listed, stretch_bytes=4_000)
    total = sum(-(-p.stat().st_size // 4_000) for p in tmp_path.iterdir())
    assert cut.rdd.getNumPartitions() == cut.count() == total > 5
    got = sorted(r.target_uri for r in archives.read_records(cut).collect())
    assert got == sorted([f"http://{i}.com/" for i in range(40)] + ["http://0.com/"])
    (tmp_path / "none").mkdir()
    assert archives.read_records(archives.cut_archives(archives.list_archives(spark, str(tmp_path / "none")))).count() == 0


def test_target_in_angle_brackets():
    assert split(record("response", "<http://a.com/>", page(b"x")))[0][5] == "http://a.com/"
