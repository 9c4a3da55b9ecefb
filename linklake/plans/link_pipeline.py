"""The link pipeline: archives to links to sites to metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake.operators import anchors, enrich, metrics, sites
from linklake.sinks.tables import write_metrics, write_sites
from linklake.sources import archives, dimensions
from linklake.storage import written

SITE_DATA_SET = "external_links.parquet"
SECTION_DATA_SET = "external_link_sections.parquet"
FIRST_BYTES = 4 << 20  # of an archive, read before its anchors are counted
PAGE = "warc_file string, record_pos bigint, page_url string, anchors array<string>"


def head_pages(
    paths: DataFrame,
    limit: int,
    limit_per_page: int | None = None,
    first_bytes: int = FIRST_BYTES,
    stretch_bytes: int = archives.STRETCH_BYTES,
) -> DataFrame:
    """Stored pages of each archive's beginning, as far as it takes to see ``limit`` anchors.

    Archives (with ``file_bytes``) are read in rounds: the first ``first_bytes`` of each, then twice as
    many more of those that have too few anchors so far, and so on. What is read of an
    archive is thus bounded by where its limit lies and not by its size; rounds are as many
    as the logarithm of the longest reading. The anchors of a round are counted per
    archive, and the counts pick the archives of the next one.
    """
    spark, rounds = paths.sparkSession, []
    left = written(paths.select("warc_file", "file_bytes", F.lit(0).cast("bigint").alias("seen")), "archives-left")
    start, length, number = 0, first_bytes, 0
    while left.limit(1).count():
        pieces = -(-length // stretch_bytes)
        piece = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece")
        cut = left.select("warc_file", "file_bytes", piece).select(
            "warc_file",
            "file_bytes",
            (F.col("piece") + number).alias("stretch"),
            (F.col("piece").cast("bigint") * stretch_bytes + start).alias("start"),
            F.least((F.col("piece").cast("bigint") + 1) * stretch_bytes, F.lit(length)).alias("end"),
        )
        # An archive whose size is not known is read whole, in the first round.
        cut = cut.where("file_bytes is null or start < file_bytes").withColumn(
            "end", F.when(F.col("file_bytes").isNull(), F.lit((1 << 63) - 1)).otherwise(F.col("end") + start)
        ).where("file_bytes is not null or stretch = 0")
        cut = written(cut.drop("file_bytes"), "stretches")
        own = cut.repartition(max(cut.count(), 1), "warc_file", "stretch")
        pages = anchors.page_anchors(archives.read_records(own, rec_types=("response",)), limit=limit_per_page)
        rounds.append(written(pages, "head-pages"))
        found = rounds[-1].groupBy("warc_file").agg(F.sum(F.size("anchors")).alias("found"))
        start, length, number = start + length, 2 * length, number + pieces
        seen = (F.col("seen") + F.coalesce("found", F.lit(0))).alias("seen")
        more = left.join(found, "warc_file", "left").select("warc_file", "file_bytes", seen)
        left = written(more.where((F.col("seen") < limit) & (F.col("file_bytes") > start)), "archives-left")
    every = rounds[0] if rounds else spark.createDataFrame([], PAGE)
    for pages in rounds[1:]:
        every = every.unionByName(pages)
    return every


def archive_links(
    paths: DataFrame, limit_per_page: int | None = None, limit_per_archive: int | None = None
) -> DataFrame:
    """Links of the archives named in ``warc_file``, with their place.

    With a limit per archive, archives are read from the start only as far as the limit asks for.
    Paths without a size are asked for it; paths that are cut already are read in full.
    """
    if not limit_per_archive:
        records = archives.read_records(paths, rec_types=("response",))
        return anchors.page_links(anchors.page_anchors(records, limit=limit_per_page))
    if "stretch" in paths.columns:
        records = archives.read_records(paths, rec_types=("response",))
        pages = written(anchors.page_anchors(records, limit=limit_per_page), "page-anchors")
    else:
        known = paths if "file_bytes" in paths.columns else archives.with_sizes(paths)
        pages = head_pages(known, limit_per_archive, limit_per_page)
    return anchors.page_links(anchors.limit_per_archive(pages, limit_per_archive))


def enriched_sites(
    links: DataFrame, tlds: DataFrame, categories: DataFrame, ad_hosts: DataFrame
) -> DataFrame:
    """Sites with country, category and ad flag, their subsections as arrays."""
    return enrich.enrich(sites.site_table(links), tlds, categories, ad_hosts)


def enriched_counts(
    links: DataFrame, tlds: DataFrame, categories: DataFrame, ad_hosts: DataFrame
) -> DataFrame:
    """The same without subsections: all that metrics need, from one shuffle."""
    return enrich.enrich(sites.site_counts(links), tlds, categories, ad_hosts)


def write_outputs(
    links: DataFrame,
    output_folder: str,
    categories: DataFrame,
    tlds: DataFrame | None = None,
    ad_hosts_file: str | None = None,
    mode: str = "errorifexists",
    weight: str | None = None,
) -> dict[str, DataFrame]:
    """Write links per site and subsection, the site data set from these, then the five
    metric tables from that.

    Subsections are rows of a data set of their own (null: the home page), whatever the
    size of a site, so none is gathered in one task. Metrics read three columns back from the written data set, two of them
    partition values, so no stage before the write runs again.
    """
    spark: SparkSession = links.sparkSession
    tlds = dimensions.country_tlds(spark) if tlds is None else tlds
    hosts = dimensions.read_ad_hosts(spark, ad_hosts_file) if ad_hosts_file else None
    if hosts is None:
        hosts = spark.createDataFrame([], "host string")
    site_path = f"{output_folder}/{SITE_DATA_SET}"
    section_path = f"{output_folder}/{SECTION_DATA_SET}"
    sites.site_sections(links).write.mode(mode).parquet(section_path)
    counts = sites.counts_of(spark.read.parquet(section_path))
    table = enrich.enrich(counts, tlds, categories, hosts)
    write_sites(table, site_path, mode)
    stored = spark.read.schema(table.schema).parquet(site_path)
    tables = metrics.compute_metrics(stored, weight)
    write_metrics(tables, output_folder)
    return tables


def run(
    spark: SparkSession,
    archive_folder: str,
    output_folder: str,
    categories: DataFrame,
    tlds: DataFrame | None = None,
    ad_hosts_file: str | None = None,
    limit_per_archive: int | None = None,
    archive_list: Sequence[str] | None = None,
    stretch_bytes: int = archives.STRETCH_BYTES,
    mode: str = "errorifexists",
) -> dict[str, DataFrame]:
    """All of it: a folder (or list) of archives to the written outputs.

    The links are stored first, as the site table reads them once and a lost
    executor then costs a column scan and not a second parse of the archives.
    """
    if archive_list is None:
        paths = archives.list_archives(spark, archive_folder)
    else:
        paths = archives.with_sizes(spark.createDataFrame([(p,) for p in archive_list], "warc_file string"))
    if not limit_per_archive:  # with a limit, archives are cut as far as they are read
        paths = archives.cut_archives(paths, stretch_bytes)
    link_store = f"{output_folder}/links"
    archive_links(paths, limit_per_archive=limit_per_archive).write.mode(mode).parquet(link_store)
    links = spark.read.parquet(link_store).select("link")
    return write_outputs(links, output_folder, categories, tlds, ad_hosts_file, mode)
