"""Whole runs: pipeline, jobs and streams."""

import shutil
import sys

import pandas as pd
from pyspark import cloudpickle
from conftest import archive, page, record
from pyspark.sql import functions as F

from linklake.operators import anchors, sites
from linklake.plans import archive_job, link_pipeline
from linklake.sources import archives
from linklake.streaming import links as streams

# Workers cannot import test modules, so the hook below goes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def make_archives(folder, count=3):
    places = []
    for n in range(count):
        raws = []
        for i in range(4):
            html = "".join(f'<a href="http://t{k}.co.uk/{n}/{i}">x</a>' for k in range(i + 1))
            raws.append(record("response", f"http://p{n}.com/{i}", page(html.encode())))
        found = archive(folder / f"{n}.warc.gz", *raws)
        places += [(f"http://p{n}.com/{i}", f"{n}.warc.gz", o, length) for i, (o, length) in enumerate(found)]
    return places


def test_pipeline(spark, tmp_path):
    (tmp_path / "in").mkdir()
    make_archives(tmp_path / "in")
    (tmp_path / "hosts").write_text("0.0.0.0 t3.co.uk\n")
    categories = spark.createDataFrame([("t0.co.uk", "News")], "domain string, category string")
    link_pipeline.run(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), categories, ad_hosts_file=str(tmp_path / "hosts")
    )
    table = spark.read.parquet(str(tmp_path / "out/external_links.parquet"))
    sections = spark.read.parquet(str(tmp_path / "out/external_link_sections.parquet")).groupBy("primary_link").agg(F.count("subsection").alias("n"))
    got = {r.primary_link: (r.frequency, r.n, r.country_code, r.category, r.is_ad_domain) for r in table.join(sections, "primary_link").collect()}
    assert got == {
        "http://p0.com": (4, 4, "US", None, False), "http://p1.com": (4, 4, "US", None, False),
        "http://p2.com": (4, 4, "US", None, False), "http://t0.co.uk": (12, 12, "GB", "News", None),
        "http://t1.co.uk": (9, 9, "GB", None, False), "http://t2.co.uk": (6, 6, "GB", None, False),
        "http://t3.co.uk": (3, 3, "GB", None, True),
    }
    read = {n: [tuple(r) for r in spark.read.parquet(str(tmp_path / f"out/{n}.parquet")).collect()]
            for n in ("top_countries", "ad_based_ratio", "category_coverage")}
    assert read == {"top_countries": [("GB", 4)], "ad_based_ratio": [(1 / 6,)], "category_coverage": [(1 / 7,)]}


def limited(pages, limit):
    """What a reader that stops at the limit would give, archive by archive."""
    out, seen = [], {}
    for name, position, url, found in sorted(pages):
        if seen.get(name, 0) >= limit:
            continue
        kept = found[: limit - seen.get(name, 0)]
        seen[name] = seen.get(name, 0) + len(kept)
        out.append((name, position, url, kept))
    return sorted(out)


def test_limit_per_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(anchors, "RECORDS_PER_BLOCK", 4)
    rows = [(f"f{n}", i, f"u{i}", [f"{n}-{i}-{k}" for k in range((i * 7 + n) % 4)]) for n in range(3) for i in range(25)]
    schema = "warc_file string, record_pos long, page_url string, anchors array<string>"
    frame = spark.createDataFrame(rows, schema)
    for limit in (1, 5, 17, 1000):
        got = sorted(tuple(r) for r in anchors.limit_per_archive(frame, limit).collect())
        assert got == limited(rows, limit)
    (tmp_path / "in").mkdir()
    make_archives(tmp_path / "in", 2)
    paths = archives.list_archives(spark, str(tmp_path / "in"))
    cut = link_pipeline.archive_links(paths, limit_per_archive=2)
    assert cut.where("link_pos > 0").count() == 4 and cut.where("link_pos = 0").count() == 4
    assert link_pipeline.archive_links(paths, limit_per_page=1).count() == 16


def sizes(frames):
    for frame in frames:
        yield pd.DataFrame({"key": frame["target_uri"].str.extract(r"//([^/]+)")[0], "val": frame["payload"].map(len)})


def test_archive_job(spark, tmp_path):
    make_archives(tmp_path)
    (tmp_path / "list.txt").write_text("0.warc.gz\n1.warc.gz\ngone.warc.gz\n")
    counts = archive_job.run_archive_job(
        spark, str(tmp_path / "list.txt"), archive_job.Output("sizes", files=2), sizes, base_uri=f"file://{tmp_path}/",
        partitions=3,
    )
    assert counts == {"inputs": 3, "records": 8, "failed": 1}
    total = sum(len("".join(f'<a href="http://t{k}.co.uk/0/{i}">x</a>' for k in range(i + 1))) for i in range(4))
    assert {tuple(r) for r in spark.table("sizes").collect()} == {("p0.com", total), ("p1.com", total)}


def test_index_record_job_with_other_reducer(spark, tmp_path):
    places = make_archives(tmp_path)
    table = spark.createDataFrame(places, "url string, warc_filename string, warc_record_offset long, warc_record_length long")
    counts = archive_job.run_index_record_job(
        spark, table.where("url like '%/3'"), archive_job.Output("longest", "json", "none", files=1), sizes,
        base_uri=f"file://{tmp_path}/", reducer=F.max("val"), partitions=2,
    )
    assert counts == {"inputs": 3, "records": 3, "failed": 0}
    assert spark.table("longest").count() == 3


def test_site_stream_survives_a_restart(spark, tmp_path):
    batches = [["http://a.com/1", "http://b.com"], ["http://a.com/2", "http://[bad"], ["http://b.com/", "http://c.com"]]
    everything = []
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame([(v,) for v in batch], "link string")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "links"))
        everything += batch
        stream = spark.readStream.schema("link string").parquet(str(tmp_path / "links"))
        streams.write_site_counts(stream, str(tmp_path / "counts"), str(tmp_path / "check"), available_now=True).awaitTermination()
        want = sites.site_counts(spark.createDataFrame([(v,) for v in everything], "link string"))
        got = streams.latest_site_counts(spark, str(tmp_path / "counts"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), n


def test_archive_stream_takes_each_archive_once(spark, tmp_path):
    (tmp_path / "new").mkdir()
    (tmp_path / "in").mkdir()
    make_archives(tmp_path / "new", 2)
    for n, total in ((0, 14), (1, 28)):
        shutil.copy(tmp_path / f"new/{n}.warc.gz", tmp_path / f"in/{n}.warc.gz")
        arriving = streams.new_archives(spark, str(tmp_path / "in"))
        streams.write_new_links(arriving, str(tmp_path / "out"), str(tmp_path / "check"), available_now=True).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == total
