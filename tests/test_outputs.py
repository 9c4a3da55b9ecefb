import json

import pytest
from pyspark.sql import functions as F

from linklake.operators import metrics
from linklake.plans import archive_job
from linklake.session import persisted, work_folder
from linklake.sinks import links as link_sink
from linklake.sinks import tables as table_sink
from linklake.sources import tables


def test_link_files(spark, tmp_path):
    raw = [" http://a.com/x,y ", 'http://b.com/"q"', "  ", None, "http://c.com/é\\", "http://d.com/,\\", "#x"]
    frame = spark.createDataFrame([(r,) for r in raw], "link string")
    link_sink.write_link_files(frame, str(tmp_path / "one"))
    lines = {r.value for r in link_sink.merge_link_files(spark, str(tmp_path / "one")).collect()}
    assert lines == {'"http://a.com/x,y"', "http://b.com/q", "http://c.com/é\\", '"http://d.com/,\\"', "#x"}
    back = {r.link for r in tables.read_link_files(spark, str(tmp_path / "one")).collect()}
    assert back == {line.strip('"') for line in lines}
    both = link_sink.merge_link_files(spark, str(tmp_path / "one"), str(tmp_path / "one"))
    assert both.count() == 10


def test_odd_link_files(spark, tmp_path):
    (tmp_path / "l.txt").write_text('http://a.com\n\n""\n"a ""b"""\n')
    assert [r.link for r in tables.read_link_files(spark, str(tmp_path / "l.txt")).collect()] == ["http://a.com", "", 'a "b"']
    (tmp_path / "bad.txt").write_text("a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_link_files(spark, str(tmp_path / "bad.txt")).collect()


def test_link_table_appends(spark):
    frame = spark.createDataFrame([("http://a.com",), (None,), ("http://b.com",)], "link string")
    for _ in range(2):
        link_sink.append_links(frame, "links_t")
    stored = spark.table("links_t")
    assert stored.count() == 4 and stored.select("id").distinct().count() == 4
    assert sorted(r.link for r in tables.read_links(spark, "links_t").collect()) == ["http://a.com"] * 2 + ["http://b.com"] * 2
    plan = tables.read_links(spark, "links_t")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<link:string>" in plan


SITES = "primary_link string, frequency long, subsections array<string>, country_code string, category string, is_ad_domain boolean"


def test_site_data_set_and_metrics(spark, tmp_path):
    rows = [("a", 1, ["/x"], "FR", None, True), ("b", 2, None, None, "News", None), ("c", 1, None, "NA", None, False)]
    frame = spark.createDataFrame(rows, SITES)
    table_sink.write_sites(frame, str(tmp_path / "s"))
    back = spark.read.schema(frame.schema).parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select(frame.columns).collect())) == sorted(rows)
    assert (tmp_path / "s" / "country_code=__HIVE_DEFAULT_PARTITION__" / "category=News").is_dir()
    for _ in range(2):
        table_sink.write_metrics(metrics.compute_metrics(back), str(tmp_path / "m"))
    assert sorted(p.name for p in (tmp_path / "m").iterdir()) == sorted(
        f"{n}.parquet" for n in metrics.compute_metrics(back)
    )
    assert spark.read.parquet(str(tmp_path / "m/top_countries.parquet")).count() == 2


def test_save_table(spark):
    frame = spark.range(100).select(F.col("id").cast("string").alias("key"), F.col("id").alias("val"))
    table_sink.save_table(frame, "kv_orc", "orc", files=3)
    assert spark.table("kv_orc").count() == 100
    assert len([f for f in spark.table("kv_orc").inputFiles() if f.endswith(".zlib.orc")]) == 3
    table_sink.save_table(frame, "kv_csv", "csv", "none", ["header=true", "sep=="], files=None)
    assert spark.table("kv_csv").count() == 100
    assert table_sink.compression_for("parquet", "gzip") == "gzip"
    assert tables.split_options(["a=b=c"]) == {"a": "b=c"}
    assert table_sink.in_files(frame, 2, shuffle=False).rdd.getNumPartitions() == 2


def test_index_job(spark, tmp_path):
    spark.createDataFrame([("http://a.com", 1), ("http://b.com", 2)], "url string, n long").write.parquet(str(tmp_path / "i"))
    (tmp_path / "s.json").write_text(
        json.dumps({"type": "struct", "fields": [{"name": "url", "type": "string", "nullable": True, "metadata": {}}]})
    )
    index = tables.load_index(spark, str(tmp_path / "i"), schema_file=str(tmp_path / "s.json"))
    assert index.columns == ["url"]
    output = archive_job.Output("picked", files=1)
    count = archive_job.run_index_job(spark, str(tmp_path / "i"), "select url from ccindex where n > 1", output, explain=True)
    assert count == 1 and [tuple(r) for r in spark.table("picked").collect()] == [("http://b.com",)]
    assert archive_job.count_rows(archive_job.select_rows(spark, "select * from ccindex")) == 2


def test_coordinate_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_text("url,warc_filename,warc_record_offset,warc_record_length\nu,f,1,2\n")
    row = tuple(tables.read_coordinates_csv(spark, str(tmp_path / "c.csv")).first())
    assert row == ("u", "f", 1, 2)
    same = tables.read_coordinates(spark, str(tmp_path / "c.csv"), "csv", ["header=True", "inferSchema=True"])
    assert tuple(same.first()) == row


def test_persisted(spark):
    rows = spark.range(5)
    with persisted(rows) as kept:
        assert kept.storageLevel.useMemory and kept.count() == 5
    assert not rows.storageLevel.useMemory


def test_work_folder(spark):
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
