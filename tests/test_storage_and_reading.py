"""Cut and limited reading, merged ranges, versions, streams over archives, look-ups."""

import gzip
import io
import shutil
import threading
import time
from collections import Counter

import pandas as pd
import pytest
from conftest import archive, page, record
from pyspark.sql import functions as F

from linklake import schemas, storage
from linklake.functions import text
from linklake.operators import anchors, category_cache, key_values, metrics
from linklake.plans import link_pipeline
from linklake.sinks import links as link_sink
from linklake.sources import archive_bytes, archives
from linklake.streaming import links as streams


def filler(n):
    """Bytes that do not compress, so that archives have a size."""
    import random

    return random.Random(n).randbytes(3_000).hex()


def big_archive(path, records, anchors_each=2):
    raws = []
    for i in range(records):
        html = f"<!-- {filler(i)} -->" + "".join(f'<a href="http://t{k}.com/{i}">x</a>' for k in range(anchors_each))
        raws.append(record("response", f"http://p.com/{i}", page(html.encode())))
    return archive(path, *raws)


# --- ranges -----------------------------------------------------------------


def test_joined_ranges():
    places = [("a", 0, 10, 1), ("a", 10, 5, 2), ("a", 12, 20, 3), ("a", 50, 10, 4), ("a", 10_000, 5, 5), ("b", 0, 3, 6), ("b", -1, -1, 7), ("b", 4, 2_000, 8)]
    got = [(p, s, n, [r for _, r in g]) for p, s, n, g in archive_bytes.joined_ranges(places, gap=20, most=100)]
    assert got == [("a", 0, 60, [1, 2, 3, 4]), ("a", 10_000, 5, [5]), ("b", 0, 3, [6]), ("b", -1, -1, [7]), ("b", 4, 2_000, [8])]


def test_a_thousand_records_need_few_requests(spark, tmp_path):
    places = big_archive(tmp_path / "x.warc.gz", 1_000)
    asked = list(archive_bytes.joined_ranges((("x", o, n, i) for i, (o, n) in enumerate(places)), most=1 << 20))
    assert len(asked) <= 10 and sum(len(g) for *_, g in asked) == 1_000
    rows = [(f"http://p.com/{i}", "x.warc.gz", o, n) for i, (o, n) in enumerate(places)] + [("gone", "y.warc.gz", 0, 10)]
    table = spark.createDataFrame(rows, "url string, warc_filename string, warc_record_offset long, warc_record_length long")
    found = archives.fetch_records(table, base_uri=f"file://{tmp_path}/", partitions=2)
    assert found.where("error is null and url = target_uri and offset = warc_record_offset and length = warc_record_length").count() == 1_000
    assert [r["url"] for r in found.where("error is not null").collect()] == ["gone"]


class Answer(io.BytesIO):
    def __init__(self, content, status, place):
        super().__init__(content)
        self.status, self.headers = status, {"Content-Range": place} if place else {}


@pytest.mark.parametrize(
    "status,place,good",
    [(206, "bytes 5-9/100", True), (206, "bytes 5-7/8", True), (200, None, False), (206, "bytes 0-4/100", False), (206, None, False), (206, "bytes 5-20/100", False)],
)
def test_web_ranges_are_checked(monkeypatch, status, place, good):
    monkeypatch.setattr(archive_bytes, "_asked", lambda uri, **_: Answer(b"12345", status, place))
    if good:
        assert archive_bytes.read_range("http://x/y", 5, 5) == b"12345"
    else:
        with pytest.raises(OSError, match="no byte range"):
            archive_bytes.read_range("http://x/y", 5, 5)


# --- listed archives and limits ---------------------------------------------


def test_listed_archives_are_sized_and_cut(spark, tmp_path):
    big_archive(tmp_path / "x.warc.gz", 200)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    names = [f"file://{tmp_path}/x.warc.gz", str(tmp_path / "empty.warc.gz"), str(tmp_path / "gone.warc.gz")]
    paths = spark.createDataFrame([(n,) for n in names], "warc_file string")
    sizes = {r["warc_file"].rsplit("/", 1)[1]: r["file_bytes"] for r in archives.with_sizes(paths).collect()}
    whole = (tmp_path / "x.warc.gz").stat().st_size
    assert sizes == {"x.warc.gz": whole, "empty.warc.gz": 0, "gone.warc.gz": None}
    cut = archives.cut_archives(archives.with_sizes(paths), stretch_bytes=100_000)
    assert cut.count() == -(-whole // 100_000) + 1 and cut.rdd.getNumPartitions() > 5
    records = archives.read_records(cut).collect()
    assert sorted(r["target_uri"] for r in records if not r["error"]) == sorted(f"http://p.com/{i}" for i in range(200))
    assert [r["warc_file"].rsplit("/", 1)[1] for r in records if r["error"]] == ["gone.warc.gz"]


def test_limited_reading_does_not_grow_with_the_archive(spark, tmp_path):
    read = {}
    for records in (100, 400):
        folder = tmp_path / str(records)
        folder.mkdir()
        big_archive(folder / "a.warc.gz", records)
        big_archive(folder / "b.warc.gz", 30, anchors_each=0)
        listed = archives.list_archives(spark, str(folder))
        head = link_pipeline.head_pages(listed, 50, first_bytes=50_000, stretch_bytes=20_000)
        read[records] = head.where("warc_file like '%/a.warc.gz'").count()
        got = anchors.limit_per_archive(head, 50).collect()
        own = [r for r in got if r["warc_file"].endswith("a.warc.gz")]
        assert sorted(r["page_url"] for r in own) == sorted(f"http://p.com/{i}" for i in range(25))
        assert sum(len(r["anchors"]) for r in own) == 50
        assert sum(r["warc_file"].endswith("b.warc.gz") for r in got) == 30  # never reaches its limit: read to the end
    assert 25 <= read[100] < 60 and read[400] == read[100]
    assert link_pipeline.head_pages(listed.limit(0), 5).count() == 0


# --- versions and look-ups --------------------------------------------------


def test_versions_count_once_whole(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert storage.versions(spark, folder) == [] and storage.names(spark, folder) == []
    for n in range(4):
        left = storage.write_version(spark.range(n).select(F.col("id")), folder, n)
    assert left == storage.versions(spark, folder) == [2, 3]
    (tmp_path / "t" / "version=9").mkdir()  # broken off
    assert storage.versions(spark, folder) == [2, 3]
    assert storage.read_version(spark, folder, 3, "id bigint").count() == 3
    assert storage.claim(spark, f"{folder}/x") and not storage.claim(spark, f"{folder}/x")


def test_look_up_asks_once(spark, tmp_path):
    folder, asked = str(tmp_path / "cache"), []
    answers = spark.createDataFrame([("a", "News"), ("a", "Art"), ("c", "Shop"), ("z", "Spam")], "domain string, category string")

    def ask(domains):
        asked.append(sorted(r["domain"] for r in domains.collect()))
        return answers

    def run(*names):
        found = category_cache.look_up(spark.createDataFrame([(n,) for n in names], "domain string"), folder, ask)
        return sorted(map(tuple, found.collect()))

    assert run("a", "b", "a", None) == [("a", "Art"), ("b", None)]
    assert run("b", "a") == [("a", "Art"), ("b", None)] and asked == [["a", "b"]]
    assert run("b", "c") == [("b", None), ("c", "Shop")] and asked == [["a", "b"], ["c"]]
    assert sorted(map(tuple, category_cache.cached_categories(spark, folder).collect())) == [("a", "Art"), ("b", None), ("c", "Shop")]
    category_cache.store_answers(spark.createDataFrame([("b",)], "domain string"), spark.createDataFrame([("b", "New")], "domain string, category string"), folder)
    assert run("b") == [("b", "New")] and len(asked) == 2


def test_loads_at_once_share_no_ids(spark, tmp_path):
    table = "links_at_once"
    link_sink.create_link_table(spark, table, location=str(tmp_path / "links"))
    frames = [spark.range(n, n + 500).select(F.concat(F.lit("http://x.com/"), "id").alias("link")).repartition(3) for n in range(0, 6_000, 1_000)]
    threads = [threading.Thread(target=link_sink.append_links, args=(f, table)) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = spark.table(table).collect()
    loads = Counter(r["id"] // link_sink.IDS_A_LOAD for r in rows)
    assert len({r["id"] for r in rows}) == len({r["link"] for r in rows}) == 3_000 and sorted(loads.values()) == [500] * 6
    for load in loads:
        own = sorted(r["id"] for r in rows if r["id"] // link_sink.IDS_A_LOAD == load)
        assert own == list(range(own[0], own[0] + 500))
    link_sink.append_links(spark.createDataFrame([], "link string"), table)
    assert spark.table(table).count() == 3_000
    assert not list(tmp_path.glob("links-staged/*"))


# --- streams ----------------------------------------------------------------


def test_arriving_archive_is_cut_and_survives_a_break(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    big_archive(tmp_path / "in/x.warc.gz", 300)
    want = Counter([f"http://p.com/{i}" for i in range(300)] + [f"http://t{k}.com/{i}" for i in range(300) for k in range(2)])
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        arriving = streams.new_archives(spark, str(tmp_path / "in"))
        query = streams.write_new_links(arriving, out, check, available_now=True, stretch_bytes=50_000, unit_bytes=200_000)
        query.awaitTermination()

    real, calls = streams.page_links, []

    def breaks_in_the_third_unit(pages):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(pages)

    monkeypatch.setattr(streams, "page_links", breaks_in_the_third_unit)
    with pytest.raises(Exception, match="lost"):
        run()
    done = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out/batch_id=0").glob("unit=*/_SUCCESS")}
    assert len(calls) == 3 and sorted(p.name for p in (tmp_path / "out/batch_id=0").iterdir() if (p / "_SUCCESS").exists()) == ["unit=0", "unit=1"]
    monkeypatch.setattr(streams, "page_links", real)
    run()
    found = spark.read.parquet(out)
    assert Counter(r["link"] for r in found.select("link").collect()) == want
    plan = spark.read.parquet(f"{check}/stretches/batch_id=0")
    assert plan.count() > 10 and plan.select("unit").distinct().count() > 2 and done
    run()  # nothing new: nothing is written twice
    assert spark.read.parquet(out).count() == sum(want.values())


def test_small_units_share_jobs(spark, tmp_path, monkeypatch):
    """Jobs grow far less than units; each unit keeps a whole folder of its own, and a break costs one job."""
    (tmp_path / "in").mkdir()
    big_archive(tmp_path / "in/x.warc.gz", 400)
    want = Counter([f"http://p.com/{i}" for i in range(400)] + [f"http://t{k}.com/{i}" for i in range(400) for k in range(2)])
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        arriving = streams.new_archives(spark, str(tmp_path / "in"))
        streams.write_new_links(arriving, out, check, available_now=True, stretch_bytes=10_000, unit_bytes=30_000).awaitTermination()

    def whole():
        return sorted(p.parent.name for p in (tmp_path / "out/batch_id=0").glob("unit=*/_SUCCESS"))

    real, calls = streams.page_links, []

    def counted(pages):
        calls.append(1)
        if len(calls) == 5:
            raise RuntimeError("lost")
        return real(pages)

    monkeypatch.setattr(streams, "page_links", counted)
    with pytest.raises(Exception, match="lost"):
        run()
    assert len(whole()) == 8 and not (tmp_path / "out/batch_id=0/_SUCCESS").exists()
    run()
    plan = spark.read.parquet(f"{check}/stretches/batch_id=0")
    units = plan.select("unit").distinct().count()
    assert units > 30 and len(calls) < 15 and len(whole()) == units
    found = spark.read.parquet(out)
    assert Counter(r["link"] for r in found.select("link").collect()) == want
    dealt = found.select("warc_file", F.shiftright("record_pos", 32).cast("int").alias("stretch"), "unit").distinct()
    assert dealt.join(plan.select("warc_file", "stretch", F.col("unit").cast("int")), ["warc_file", "stretch", "unit"], "left_anti").count() == 0


def test_tasks_follow_bytes_where_stretches_are_small(spark):
    paths = spark.createDataFrame([("a", 30 << 20), ("b", None)], "warc_file string, file_bytes bigint")
    cut = archives.cut_archives(paths, stretch_bytes=30_000)
    assert cut.count() == -(-(30 << 20) // 30_000) + 1 and 8 <= cut.rdd.getNumPartitions() <= 40


def test_hooks_get_bounded_batches(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = spark.range(5_000).coalesce(1).select(F.lit(None).cast("string").alias("error"), "id")
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, 10_000)
        sizes = key_values.apply_hook(rows, lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), schemas.columns("n long")).collect()
        assert sum(r["n"] for r in sizes) == 5_000 and max(r["n"] for r in sizes) <= 1_000
        spark.conf.set(key, 100)  # smaller ones are left alone
        key_values.apply_hook(rows, lambda frames: frames, schemas.columns("error string, id long"))
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, before)


def test_small_members_are_not_copied_along(tmp_path):
    """What is left of a block is not copied at each member's end."""
    import zlib as real

    data = b"".join(gzip.compress(record("request", f"http://a.com/{i}", b"GET / HTTP/1.1")) for i in range(3_000))
    (tmp_path / "a.warc.gz").write_bytes(data)
    handed = []

    class Counting:
        def __init__(self, bits):
            self.inner = real.decompressobj(bits)

        def decompress(self, content, *most):
            handed.append(len(content))
            return self.inner.decompress(content, *most)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    class Zlib:
        error, decompressobj = real.error, Counting

    before = archive_bytes.zlib
    archive_bytes.zlib = Zlib
    try:
        records = list(archive_bytes.split_stretch(str(tmp_path / "a.warc.gz"), 0, 0, len(data)))
    finally:
        archive_bytes.zlib = before
    assert len(records) == 3_000 and sum(handed) < 20_000 * len(handed)


def test_compaction_bounds_what_is_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    everything, flush = [], streams.Flush(max_files=1)
    out = str(tmp_path / "counts")
    for n in range(25):
        links = [f"http://s{n % 4}.com/{n}", f"http://only{n}.com"]
        everything += links
        (tmp_path / f"in/{n:03d}.txt").write_text("\n".join(links))
    arriving = flush.admitting(spark.readStream.schema("value string")).text(str(tmp_path / "in")).withColumnRenamed("value", "link")
    streams.write_site_counts(arriving, out, str(tmp_path / "check"), available_now=True, compact_every=5, flush=flush).awaitTermination()
    got = dict(map(tuple, streams.latest_site_counts(spark, out).collect()))
    assert got == Counter(link.rsplit("/", 1)[0] if link.count("/") > 2 else link for link in everything)
    assert storage.versions(spark, f"{out}/base") == [19, 24]
    assert len(storage.numbered(spark, f"{out}/changes", "batch_id")) <= 10
    before = {p.name for p in (tmp_path / "counts/changes").iterdir()}
    streams.compact_site_counts(spark, out)
    assert dict(map(tuple, streams.latest_site_counts(spark, out).collect())) == got and before
    assert streams.latest_site_counts(spark, str(tmp_path / "none")).count() == 0


def test_flush_admits_no_more_than_its_bound(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(5):
        big_archive(tmp_path / f"in/{n}.warc.gz", 5)
    size = (tmp_path / "in/0.warc.gz").stat().st_size
    flush = streams.Flush(interval="1 second", max_bytes=2 * size + 1_000)
    arriving = streams.new_archives(spark, str(tmp_path / "in"), flush=flush)
    query = streams.write_new_links(arriving, str(tmp_path / "out"), str(tmp_path / "check"), flush=flush)
    try:
        until = time.time() + 90
        while time.time() < until and len(storage.names(spark, str(tmp_path / "out"))) < 3:
            time.sleep(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
    found = spark.read.parquet(str(tmp_path / "out"))
    files = dict(map(tuple, found.groupBy("batch_id").agg(F.count_distinct("warc_file")).collect()))
    assert found.count() == 75 and len(files) == 3 and max(files.values()) == 2
    with pytest.raises(ValueError, match="not by both"):
        streams.Flush(max_files=1, max_bytes=1).admitting(None)


# --- metrics and charsets ---------------------------------------------------


def test_metrics_scan_the_sites_once(spark, tmp_path):
    rows = [(f"s{i}", i, ["FR", None, "US"][i % 3], [None, "News"][i % 2], i % 4 == 0) for i in range(50)]
    spark.createDataFrame(rows, "primary_link string, frequency long, country_code string, category string, is_ad_domain boolean").write.parquet(str(tmp_path / "s"))
    sites = spark.read.parquet(str(tmp_path / "s"))
    plan = metrics.totals(sites)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    shutil.copytree(tmp_path / "s", tmp_path / "kept")
    tables = metrics.compute_metrics(sites)
    shutil.rmtree(tmp_path / "s")  # nothing is read from it any more
    assert {n: t.count() for n, t in tables.items()} == {
        "category_coverage": 1, "links_by_category": 2, "top_countries": 1, "ad_based_ratio": 1, "ad_domain_by_country": 3,
    }


def test_charsets_native_and_not(spark):
    raws = [b"plain", "caf\xe9 \xff".encode("latin-1"), "é ß".encode(), b"\x80\xc3\xa9\xff", "日本".encode("shift_jis"), "é".encode("utf-16"), b"", b"\xd8\x00\xdc"]
    names = ["utf-8", "UTF8", "ISO-8859-1", "latin1", "us-ascii", "ASCII", "Shift_JIS", "utf-16", "utf-16le", "windows-1252", "koi8-r", None, "", "none-such"]

    def want(raw, name):
        try:
            return raw.decode(name or "utf-8", errors="replace")
        except LookupError:
            return raw.decode("utf-8", errors="replace")

    rows = [(r, n) for r in raws for n in names] + [(None, "utf-8"), (None, "koi8-r")]
    frame = spark.createDataFrame(rows, "p binary, c string")
    got = frame.select("p", "c", text.decode_with_charset(F.col("p"), F.col("c")).alias("t")).collect()
    for r in got:
        assert r["t"] == (None if r["p"] is None else want(bytes(r["p"]), r["c"])), r
