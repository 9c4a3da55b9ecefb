"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake.functions import records as rec
from linklake.functions import urls
from linklake.functions.text import clean_link, decode_with_charset, has_clean_text
from linklake.operators import anchors, enrich, key_values, metrics, sites
from linklake.plans import archive_job, link_pipeline
from linklake.session import work_folder
from linklake.sinks import links as link_sink
from linklake.sinks import tables as table_sink
from linklake.sources import archives, dimensions, manifest, tables
from linklake.streaming import links as streams
from verification import inputs
from verification.archive_files import write_archives
from verification.job_queries import JOB_QUERIES

# The record hook below travels with the job, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTITION = "2025-13"


def _joined(column: str):
    return F.array_join(column, "\n").alias(column)


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    categories = dimensions.category_table(inputs.category_replies(spark, sf_dir))
    hosts = dimensions.ad_host_rows(inputs.rows(spark, sf_dir, "supplier", inputs.HOST_LINES))
    return dimensions.country_tlds(spark), categories, hosts


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_pipeline.enriched_counts(inputs.links(spark, sf_dir), *_dimensions(spark, sf_dir))


# --- links and URLs ---------------------------------------------------------


def primary_link_projection(spark, sf_dir):
    links = inputs.links(spark, sf_dir).unionAll(
        spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("url").alias("link"))
    )
    return sites.link_parts(links).drop("link")


def homepage_split(spark, sf_dir):
    parts = sites.link_parts(inputs.links(spark, sf_dir))
    return parts.groupBy("is_homepage", "subsection").agg(F.count(F.lit(1)).alias("links"))


def clean_links(spark, sf_dir):
    dirty = inputs.rows(spark, sf_dir, "lineitem", inputs.DIRTY_LINKS)
    cleaned = dirty.where(has_clean_text(F.col("link"))).select(clean_link(F.col("link")).alias("link"))
    return cleaned.groupBy("link").agg(F.count(F.lit(1)).alias("links"))


def encode_url_path(spark, sf_dir):
    odd = inputs.rows(spark, sf_dir, "pages", inputs.ODD_URLS)
    return odd.select("page_id", urls.encode_url_path(F.col("url")).alias("encoded"))


def url_hosts(spark, sf_dir):
    host = urls.host(F.col("url"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", host.alias("host"), urls.fqdn(host).alias("fqdn"))


def registered_suffix(spark, sf_dir):
    counts = sites.site_counts(inputs.links(spark, sf_dir))
    hosts = enrich.with_host(counts).select(F.col("_host").alias("host"))
    rules = spark.sql(f"select * from values {inputs.SUFFIX_RULES} as r(rule)")
    return enrich.add_registered_domain(hosts, rules)


# --- sites --------------------------------------------------------------------


def site_frequency(spark, sf_dir):
    return sites.site_counts(inputs.links(spark, sf_dir))


def site_table(spark, sf_dir):
    table = sites.site_table(inputs.links(spark, sf_dir))
    return table.select("primary_link", "frequency", _joined("subsections"))


def site_table_in_parts(spark, sf_dir):
    links = inputs.links(spark, sf_dir)
    table = sites.site_table(links, parts=4).select("primary_link", F.explode("subsections").alias("subsection"))
    return table.join(sites.site_counts(links), "primary_link")


def site_sections(spark, sf_dir):
    return sites.site_sections(inputs.links(spark, sf_dir))


def site_country(spark, sf_dir):
    table = sites.site_counts(inputs.links(spark, sf_dir))
    return enrich.add_country(table, dimensions.country_tlds(spark))


def site_category(spark, sf_dir):
    categories = dimensions.category_table(inputs.category_replies(spark, sf_dir))
    return enrich.add_category(sites.site_counts(inputs.links(spark, sf_dir)), categories)


def ad_flag(spark, sf_dir):
    return _enriched(spark, sf_dir).select("primary_link", "category", "is_ad_domain")


def ad_sites(spark, sf_dir):
    hosts = _dimensions(spark, sf_dir)[2]
    return enrich.only_ad_sites(sites.site_counts(inputs.links(spark, sf_dir)), hosts)


def enriched_site_table(spark, sf_dir):
    table = link_pipeline.enriched_sites(inputs.links(spark, sf_dir), *_dimensions(spark, sf_dir))
    return table.select(
        "primary_link", "frequency", _joined("subsections"), "country_code", "category", "is_ad_domain"
    )


def site_domains(spark, sf_dir):
    return enrich.site_domains(sites.site_counts(inputs.links(spark, sf_dir)))


def uncached_domains(spark, sf_dir):
    known = inputs.category_replies(spark, sf_dir).where(F.size("categories") > 0)
    return enrich.unknown_domains(site_domains(spark, sf_dir), known)


# --- dimensions -------------------------------------------------------------


def best_category(spark, sf_dir):
    replies = inputs.category_replies(spark, sf_dir)
    best = dimensions.best_category(F.col("categories"))
    return replies.select("domain", best.alias("category"), F.size("categories").alias("entries"))


def country_dim(spark, sf_dir):
    lines = inputs.rows(spark, sf_dir, "supplier", inputs.COUNTRY_LINES)
    return dimensions.country_rows(lines, F.col("pos"))


def ads_dim(spark, sf_dir):
    return dimensions.ad_host_rows(inputs.rows(spark, sf_dir, "supplier", inputs.HOST_LINES))


# --- metrics ------------------------------------------------------------------


def _metric(name: str, **options: str):
    def query(spark, sf_dir):
        return getattr(metrics, name)(_enriched(spark, sf_dir), **options)

    return query


# --- pages and archives -------------------------------------------------------


def page_anchors(spark, sf_dir):
    pages = anchors.page_anchors(inputs.response_pages(spark, sf_dir))
    return pages.select("record_pos", F.posexplode("anchors").alias("link_pos", "link"))


def page_links_union(spark, sf_dir):
    return anchors.page_links(anchors.page_anchors(inputs.page_records(spark, sf_dir)))


def links_limited_per_page(spark, sf_dir):
    pages = anchors.page_anchors(inputs.response_pages(spark, sf_dir), limit=2)
    return anchors.page_links(pages)


def links_limited_per_file(spark, sf_dir):
    folder = work_folder(spark, "page-anchors")
    pages = anchors.page_anchors(inputs.response_pages(spark, sf_dir))
    pages.write.parquet(folder)
    stored = spark.read.schema(pages.schema).parquet(folder)
    return anchors.page_links(anchors.limit_per_archive(stored, 50))


def html_records(spark, sf_dir):
    return inputs.page_records(spark, sf_dir).select(
        "record_pos",
        rec.is_response(F.col("rec_type")).alias("is_response"),
        rec.is_extracted_text(F.col("rec_type"), F.col("content_type")).alias("is_text"),
        rec.is_json_metadata(F.col("rec_type"), F.col("content_type")).alias("is_json"),
        rec.declares_html(F.col("http_headers")).alias("declares_html"),
        rec.is_html(F.col("warc_headers"), F.col("http_headers")).alias("is_html"),
    )


def _archives(spark, sf_dir) -> tuple[str, DataFrame]:
    folder = work_folder(spark, "archives")
    return f"{folder}/archives", write_archives(inputs.html_pages(spark, sf_dir), folder)


def warc_roundtrip(spark, sf_dir):
    folder, _ = _archives(spark, sf_dir)
    records = archives.read_records(archives.list_archives(spark, folder), rec_types=("response",))
    return records.select(
        "target_uri", F.md5("payload").alias("digest"), F.length("payload").cast("bigint").alias("bytes"), "error"
    )


def warc_in_stretches(spark, sf_dir):
    folder, _ = _archives(spark, sf_dir)
    cut = archives.cut_archives(archives.list_archives(spark, folder), stretch_bytes=50_000)
    records = archives.read_records(cut, rec_types=("response",))
    return records.select("target_uri", F.md5("payload").alias("digest"), "error")


def warc_by_coordinates(spark, sf_dir):
    folder, index = _archives(spark, sf_dir)
    records = archives.fetch_records(index, base_uri=f"{folder}/")
    text = decode_with_charset(F.col("payload"), F.col("content_charset"))
    return records.select("url", "target_uri", "rec_type", F.md5(text.cast("binary")).alias("digest"))


def warc_site_counts(spark, sf_dir):
    folder, _ = _archives(spark, sf_dir)
    cut = archives.cut_archives(archives.list_archives(spark, folder))
    return sites.site_counts(link_pipeline.archive_links(cut))


def _pipeline_output(spark, sf_dir):
    """A whole run over archives of the pages, to files."""
    folder, _ = _archives(spark, sf_dir)
    out = work_folder(spark, "pipeline")
    tlds, categories, _ = _dimensions(spark, sf_dir)
    link_pipeline.run(spark, folder, out, categories, tlds)
    return out


def pipeline_sites(spark, sf_dir):
    table = spark.read.parquet(f"{_pipeline_output(spark, sf_dir)}/{link_pipeline.SITE_DATA_SET}")
    return table.select("primary_link", "frequency")


def pipeline_sections(spark, sf_dir):
    table = spark.read.parquet(f"{_pipeline_output(spark, sf_dir)}/{link_pipeline.SECTION_DATA_SET}")
    return table.select("primary_link", "subsection", "links")


def pipeline_metrics(spark, sf_dir):
    """The metric that lists countries, read back from its file."""
    return spark.read.parquet(f"{_pipeline_output(spark, sf_dir)}/top_countries.parquet")


# --- manifests ----------------------------------------------------------------


def manifest_paths(spark, sf_dir):
    lines = inputs.rows(spark, sf_dir, "orders", inputs.MANIFEST)
    return manifest.archive_paths(lines, PARTITION)


def manifest_pick(spark, sf_dir):
    return manifest.pick_first(inputs.rows(spark, sf_dir, "orders", inputs.MANIFEST), PARTITION)


def manifest_prefix_semi(spark, sf_dir):
    lines = inputs.rows(spark, sf_dir, "orders", inputs.MANIFEST)
    return manifest.lines_with_prefix(lines, manifest.pick_first(lines, PARTITION, count=7))


# --- jobs -----------------------------------------------------------------------


def key_value_sum(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = documents.select(F.explode(F.split("text", " ")).alias("key"), F.lit(1).alias("val"))
    return key_values.reduce_by_key(words)


def key_value_max(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = documents.select(F.col("source").alias("key"), F.length("text").alias("val"))
    return key_values.reduce_by_key(sizes, F.max("val").cast("bigint"))


def _bytes_by_type(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"key": frame["rec_type"], "val": frame["payload"].map(len)})


def record_hook_sum(spark, sf_dir):
    pairs = key_values.apply_hook(inputs.page_records(spark, sf_dir), _bytes_by_type)
    return key_values.reduce_by_key(pairs)


def index_sql_select(spark, sf_dir):
    tables.load_index(spark, f"{sf_dir}/pages.parquet", view="page_index")
    return archive_job.select_rows(spark, inputs.INDEX_QUERY)


def selection_count(spark, sf_dir):
    return index_sql_select(spark, sf_dir).agg(F.count(F.lit(1)).alias("matched"))


def _output(spark, name: str) -> archive_job.Output:
    """A job's table under the shared working folder, with a name of its own."""
    folder = work_folder(spark, name)
    return archive_job.Output(folder.rsplit("/", 1)[1].replace("-", "_"), options=[f"path={folder}"])


def _response_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = frame[frame["rec_type"] == "response"]
        yield pd.DataFrame(
            {"key": found["target_uri"].str.split(":").str[0], "val": found["payload"].map(len)}
        )


def archive_job_table(spark, sf_dir):
    folder, _ = _archives(spark, sf_dir)
    names = archives.list_archives(spark, folder).select(F.substring_index("warc_file", "/", -1))
    names.write.text(f"{folder}-list")
    output = _output(spark, "archive-job")
    archive_job.run_archive_job(
        spark, f"{folder}-list", output, _response_bytes, base_uri=f"{folder}/", partitions=8
    )
    return spark.table(output.table)


def index_job_table(spark, sf_dir):
    output = _output(spark, "index-job")
    archive_job.run_index_job(
        spark, f"{sf_dir}/pages.parquet", inputs.INDEX_QUERY, output, view="page_index"
    )
    return spark.table(output.table)


def index_record_job_table(spark, sf_dir):
    folder, index = _archives(spark, sf_dir)
    output = _output(spark, "index-record-job")
    archive_job.run_index_record_job(
        spark, index, output, _response_bytes, base_uri=f"{folder}/", reducer=F.max("val"), partitions=8
    )
    return spark.table(output.table)


def job_counters(spark, sf_dir):
    folder, index = _archives(spark, sf_dir)
    counts = archive_job.run_index_record_job(
        spark, index, _output(spark, "counted-job"), _response_bytes, base_uri=f"{folder}/", partitions=8
    )
    names = ["inputs", "records", "failed"]
    return spark.range(1).select(*[F.lit(counts[n]).cast("bigint").alias(n) for n in names])


# --- sinks ----------------------------------------------------------------------


def link_file_roundtrip(spark, sf_dir):
    folder = work_folder(spark, "link-files")
    dirty = inputs.rows(spark, sf_dir, "lineitem", inputs.DIRTY_LINKS)
    link_sink.write_link_files(dirty, folder)
    back = tables.read_link_files(spark, folder)
    return back.groupBy("link").agg(F.count(F.lit(1)).alias("links"))


def link_table_roundtrip(spark, sf_dir):
    folder = work_folder(spark, "link-table")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    link_sink.create_link_table(spark, table, location=folder)
    for _ in range(2):
        link_sink.append_links(inputs.links(spark, sf_dir), table)
    return tables.read_links(spark, table).groupBy("link").agg(F.count(F.lit(1)).alias("links"))


def partitioned_sink_roundtrip(spark, sf_dir):
    folder = work_folder(spark, "sites")
    table = _enriched(spark, sf_dir)
    table_sink.write_sites(table, folder)
    back = spark.read.schema(table.schema).parquet(folder)
    return back.select("primary_link", "frequency", "country_code", "category", "is_ad_domain")


# --- streams --------------------------------------------------------------------


def stream_site_frequency(spark, sf_dir):
    folder = work_folder(spark, "site-stream")
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    arriving = (
        spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    )
    arriving.createOrReplaceTempView("arriving_items")
    links = spark.sql(inputs.LINKS.replace("from lineitem", "from arriving_items"))
    streams.write_site_counts(
        links, f"{folder}/counts", f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    return streams.latest_site_counts(spark, f"{folder}/counts")


QUERIES = {
    "primary_link_projection": primary_link_projection,
    "homepage_split": homepage_split,
    "clean_links": clean_links,
    "encode_url_path": encode_url_path,
    "url_hosts": url_hosts,
    "registered_suffix": registered_suffix,
    "site_frequency": site_frequency,
    "site_table": site_table,
    "site_table_in_parts": site_table_in_parts,
    "site_sections": site_sections,
    "site_country": site_country,
    "site_category": site_category,
    "ad_flag": ad_flag,
    "ad_sites": ad_sites,
    "enriched_site_table": enriched_site_table,
    "site_domains": site_domains,
    "uncached_domains": uncached_domains,
    "best_category": best_category,
    "country_dim": country_dim,
    "ads_dim": ads_dim,
    "category_coverage": _metric("category_coverage"),
    "links_by_category": _metric("links_by_category"),
    "top_countries": _metric("top_countries"),
    "ad_based_ratio": _metric("ad_based_ratio"),
    "ad_domain_by_country": _metric("ad_domain_by_country"),
    "weighted_links_by_category": _metric("links_by_category", weight="frequency"),
    "page_anchors": page_anchors,
    "page_links_union": page_links_union,
    "links_limited_per_page": links_limited_per_page,
    "links_limited_per_file": links_limited_per_file,
    "html_records": html_records,
    "warc_roundtrip": warc_roundtrip,
    "warc_in_stretches": warc_in_stretches,
    "warc_by_coordinates": warc_by_coordinates,
    "warc_site_counts": warc_site_counts,
    "pipeline_sites": pipeline_sites,
    "pipeline_sections": pipeline_sections,
    "pipeline_metrics": pipeline_metrics,
    "manifest_paths": manifest_paths,
    "manifest_pick": manifest_pick,
    "manifest_prefix_semi": manifest_prefix_semi,
    "key_value_sum": key_value_sum,
    "key_value_max": key_value_max,
    "record_hook_sum": record_hook_sum,
    "index_sql_select": index_sql_select,
    "selection_count": selection_count,
    "archive_job_table": archive_job_table,
    "index_job_table": index_job_table,
    "index_record_job_table": index_record_job_table,
    "job_counters": job_counters,
    "link_table_roundtrip": link_table_roundtrip,
    "link_file_roundtrip": link_file_roundtrip,
    "partitioned_sink_roundtrip": partitioned_sink_roundtrip,
    "stream_site_frequency": stream_site_frequency,
    **JOB_QUERIES,
}
