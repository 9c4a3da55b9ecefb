"""Registered queries over archives, streams, stored tables and jobs that are written and read back."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake import schemas
from linklake.functions.text import decode_with_charset
from linklake.operators import anchors, category_cache, enrich, key_values, sites
from linklake.plans import archive_job, link_pipeline
from linklake.session import persisted, work_folder
from linklake.sinks import links as link_sink
from linklake.sinks import tables as table_sink
from linklake.sources import archives, dimensions, manifest, tables
from linklake.streaming import links as streams
from verification import inputs
from verification.archive_files import write_archives

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTITION = "2025-13"


def _archives(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    folder = work_folder(spark, "archives")
    return f"{folder}/archives", write_archives(inputs.html_pages(spark, sf_dir), folder)


def _counted(links: DataFrame) -> DataFrame:
    return links.groupBy("link").agg(F.count(F.lit(1)).alias("links"))


# --- streams ----------------------------------------------------------------


def stream_archive_links(spark, sf_dir):
    """Archives that arrive two at a time, cut into stretches, committed in units."""
    folder, _ = _archives(spark, sf_dir)
    out = work_folder(spark, "link-stream")
    arriving = streams.new_archives(spark, folder, flush=streams.Flush(max_files=2))
    streams.write_new_links(
        arriving, f"{out}/links", f"{out}/checkpoint", available_now=True, stretch_bytes=50_000, unit_bytes=150_000
    ).awaitTermination()
    return _counted(spark.read.parquet(f"{out}/links"))


def stream_counts_compacted(spark, sf_dir):
    """Links that arrive file by file; counts are compacted every third batch."""
    folder = work_folder(spark, "link-files")
    inputs.links(spark, sf_dir).repartition(8).write.parquet(f"{folder}/in")
    flush = streams.Flush(max_files=1)
    arriving = flush.admitting(spark.readStream.schema(schemas.LINK)).parquet(f"{folder}/in")
    streams.write_site_counts(
        arriving, f"{folder}/counts", f"{folder}/checkpoint", available_now=True, compact_every=3, flush=flush
    ).awaitTermination()
    return streams.latest_site_counts(spark, f"{folder}/counts")


# --- look-ups ---------------------------------------------------------------


def category_cache_rounds(spark, sf_dir):
    """Two rounds of look-ups; the second finds everything in the table, misses included."""
    folder = work_folder(spark, "category-cache")
    domains = enrich.site_domains(sites.site_counts(inputs.links(spark, sf_dir)))
    replies = dimensions.category_table(inputs.category_replies(spark, sf_dir))
    rounds = []

    def ask(asked: DataFrame) -> DataFrame:
        rounds.append(asked)
        return replies.join(asked, "domain", "left_semi").where("category is not null")

    for _ in range(2):
        found = category_cache.look_up(domains, folder, ask)
    return found.select("domain", "category", F.lit(len(rounds)).alias("rounds_asked"))


# --- archives ---------------------------------------------------------------


def links_limited_early(spark, sf_dir):
    """Early stop against a full reading: links of one that the other lacks, pages it left unread."""
    folder, _ = _archives(spark, sf_dir)
    listed = archives.list_archives(spark, folder)
    head = link_pipeline.head_pages(listed, 20, first_bytes=15_000, stretch_bytes=10_000)
    found = anchors.page_links(anchors.limit_per_archive(head, 20)).select("warc_file", "link_pos", "link")
    pages = anchors.page_anchors(archives.read_records(listed, rec_types=("response",)))
    stored = work_folder(spark, "all-pages")
    pages.write.parquet(stored)
    pages = spark.read.schema(pages.schema).parquet(stored)
    want = anchors.page_links(anchors.limit_per_archive(pages, 20)).select("warc_file", "link_pos", "link")
    counts = found.withColumn("n", F.lit(1)).unionByName(want.withColumn("n", F.lit(-1)))
    odd = counts.groupBy("warc_file", "link_pos", "link").agg(F.sum("n").alias("n")).where("n <> 0")
    return odd.agg(F.count("*").alias("differences"), F.lit(head.count() < pages.count()).alias("stopped_early"))


def listed_archives_cut(spark, sf_dir):
    """Archives named in a list, sizes asked for by tasks, read in stretches; one is missing."""
    folder, _ = _archives(spark, sf_dir)
    names = archives.list_archives(spark, folder).select(F.substring_index("warc_file", "/", -1))
    names.union(spark.sql("select 'gone.warc.gz'")).write.text(f"{folder}-list")
    paths = archives.archive_paths(spark, f"{folder}-list", base_uri=f"{folder}/")
    cut = archives.cut_archives(archives.with_sizes(paths), stretch_bytes=30_000)
    records = archives.read_records(cut, rec_types=("response",))
    return records.select("target_uri", F.md5("payload").alias("digest"), F.col("error").isNotNull().alias("failed"))


def coordinates_csv(spark, sf_dir):
    """Coordinates in a CSV file and in a table of another format give the same records."""
    folder, index = _archives(spark, sf_dir)
    places = index.select("url", "warc_filename", "warc_record_offset", "warc_record_length")
    places.where("page_id % 2 = 0").write.option("header", True).csv(f"{folder}-csv")
    places.where("page_id % 2 = 1").write.option("sep", "|").option("header", True).csv(f"{folder}-other")
    read = tables.read_coordinates_csv(spark, f"{folder}-csv")
    other = tables.read_coordinates(spark, f"{folder}-other", "csv", ["header=true", "sep=|", "inferSchema=true"])
    records = archives.fetch_records(read.unionByName(other), base_uri=f"{folder}/")
    return records.select("url", "target_uri", F.md5("payload").alias("digest"))


def _placed_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Uses what the index row and the archive give: url, offset and length."""
    for frame in frames:
        right = (frame["offset"] == frame["warc_record_offset"]) & (frame["length"] == frame["warc_record_length"])
        yield pd.DataFrame({"scheme": frame["url"].str.split(":").str[0], "placed": right, "bytes": frame["payload"].map(len)})


def hook_with_index_row(spark, sf_dir):
    """A hook that reads index columns, offset and length, with a schema of its own."""
    folder, index = _archives(spark, sf_dir)
    schema = schemas.columns("scheme string, placed boolean, bytes long")
    records = archives.fetch_records(index, base_uri=f"{folder}/")
    found = key_values.apply_hook(records, _placed_bytes, schema)
    return found.groupBy("scheme", "placed").agg(F.count("*").alias("records"), F.sum("bytes").alias("bytes"))


def _chars_by_host(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        own = frame[frame["rec_type"] == "response"]
        yield pd.DataFrame({"host": own["target_uri"].str.split("/").str[2], "size": own["payload"].map(len).astype(float)})


def job_with_own_schema(spark, sf_dir):
    """An archive job whose rows are not key and value."""
    folder, _ = _archives(spark, sf_dir)
    schema = schemas.columns("host string, size double")
    records = archives.read_records(archives.cut_archives(archives.list_archives(spark, folder), 50_000))
    pairs = key_values.apply_hook(records, _chars_by_host, schema)
    return key_values.reduce_by_key(pairs, F.sum("size"), key="host")


# --- stored tables ----------------------------------------------------------


def link_table_ids(spark, sf_dir):
    """Ids of several loads: all different, dense inside each load."""
    folder = work_folder(spark, "link-table")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    link_sink.create_link_table(spark, table, location=folder)
    for _ in range(2):
        link_sink.append_links(inputs.links(spark, sf_dir), table)
    load = F.floor(F.col("id") / link_sink.IDS_A_LOAD).alias("load")
    spans = spark.table(table).groupBy(load).agg(
        F.count("*").alias("links"), F.count_distinct("id").alias("ids"), (F.max("id") - F.min("id") + 1).alias("span")
    )
    return spans


def links_of_several_folders(spark, sf_dir):
    """Link files of two writers, read as one."""
    folder = work_folder(spark, "link-files")
    links = inputs.links(spark, sf_dir)
    link_sink.write_link_files(links, f"{folder}/a")
    link_sink.write_link_files(links.where("link like 'https%'"), f"{folder}/b")
    lines = link_sink.merge_link_files(spark, f"{folder}/a", f"{folder}/b")
    return lines.groupBy(F.col("value").alias("link")).agg(F.count(F.lit(1)).alias("links"))


def table_in_files(spark, sf_dir):
    """A result saved in a fixed number of files, merged from the tasks that made it."""
    folder = work_folder(spark, "few-files")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    counts = sites.site_counts(inputs.links(spark, sf_dir))
    table_sink.save_table(counts, name, options=[f"path={folder}"], files=2, shuffle=False)
    files = F.input_file_name()
    return spark.table(name).select(files.alias("file"), "frequency").agg(
        (F.count_distinct("file") <= 2).alias("few_files"), F.count("*").alias("sites"), F.sum("frequency").alias("links")
    )


def selection_used_twice(spark, sf_dir):
    """A selection that is explained, kept, counted and then used."""
    tables.load_index(spark, f"{sf_dir}/pages.parquet", view="page_index")
    with persisted(archive_job.select_rows(spark, inputs.INDEX_QUERY, explain=True)) as rows:
        count = archive_job.count_rows(rows)
        longest = rows.agg(F.max("html_length").alias("longest")).first()[0]
    return spark.range(1).select(F.lit(count).alias("matched"), F.lit(longest).cast("bigint").alias("longest"))


def manifest_from_file(spark, sf_dir):
    """Paths of a partition from a gzipped manifest."""
    folder = work_folder(spark, "manifest")
    inputs.rows(spark, sf_dir, "orders", inputs.MANIFEST).write.option("compression", "gzip").text(folder)
    return manifest.archive_paths(manifest.read_manifest(spark, folder), PARTITION)


def odd_links_by_site(spark, sf_dir):
    """Null, empty and invalid links among the others: stored without nulls, counted without invalid ones."""
    folder = work_folder(spark, "odd-links")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    link_sink.create_link_table(spark, table, location=folder)
    link_sink.append_links(inputs.rows(spark, sf_dir, "lineitem", inputs.ODD_LINKS), table)
    counts = sites.site_counts(tables.read_links(spark, table))
    stored = spark.table(table).select(F.lit("(stored)").alias("primary_link")).groupBy("primary_link")
    return counts.unionByName(stored.agg(F.count("*").alias("frequency")))


def pipeline_metric_files(spark, sf_dir):
    """All five metric tables of a run, read back from their files."""
    folder, _ = _archives(spark, sf_dir)
    out = work_folder(spark, "pipeline")
    categories = dimensions.category_table(inputs.category_replies(spark, sf_dir))
    names = list(link_pipeline.run(spark, folder, out, categories, dimensions.country_tlds(spark)))
    found = None
    for name in names:
        table = spark.read.parquet(f"{out}/{name}.parquet")
        key = F.col(table.columns[0]).cast("string") if len(table.columns) > 1 else F.lit(None).cast("string")
        rows = table.select(F.lit(name).alias("metric"), key.alias("key"), F.col(table.columns[-1]).cast("double").alias("value"))
        found = rows if found is None else found.unionByName(rows)
    return found


# --- payloads ---------------------------------------------------------------


def payload_charsets(spark, sf_dir):
    """Payloads in five charsets, some with bytes that are wrong in theirs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kind, text = F.col("doc_id") % 5, F.col("text")
    payload = (
        F.when(kind == 0, F.concat(F.encode(text, "UTF-8"), F.lit(b"\xff\xc3")))
        .when(kind == 1, F.encode(text, "ISO-8859-1"))
        .when(kind == 2, F.encode(text, "UTF-8"))
        .when(kind == 3, F.encode(text, "UTF-16LE"))
        .otherwise(F.encode(text, "ISO-8859-1"))
    )
    names = ["UTF-8", "iso_8859-1", "US-ASCII", "utf-16le", "windows-1252"]
    charset = F.element_at(F.array(*map(F.lit, names)), (kind + 1).cast("int"))
    found = docs.select("doc_id", payload.alias("payload"), charset.alias("charset"))
    return found.select("doc_id", F.md5(decode_with_charset(F.col("payload"), F.col("charset"))).alias("digest"))


JOB_QUERIES = {
    f.__name__: f
    for f in (
        stream_archive_links, stream_counts_compacted, category_cache_rounds, links_limited_early, listed_archives_cut,
        coordinates_csv, hook_with_index_row, job_with_own_schema, link_table_ids, links_of_several_folders,
        table_in_files, selection_used_twice, manifest_from_file, odd_links_by_site, pipeline_metric_files, payload_charsets,
    )
}
