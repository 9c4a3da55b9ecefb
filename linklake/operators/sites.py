"""From links to sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.functions import urls

def _cut(links: DataFrame) -> DataFrame:
    """Site and path of each link, which is cut up once into a column of its own."""
    parts = F.col("_parts")
    return links.select("link", urls.split_link(F.col("link")).alias("_parts")).select(
        "link", urls.site_of(parts).alias("primary_link"), urls.path_of(parts).alias("_path")
    )


def link_parts(links: DataFrame) -> DataFrame:
    """Site, home page flag and subsection of each link; an invalid URL has no
    site and no subsection and is no home page."""
    valid = urls.is_valid_url(F.col("link"))
    flagged = _cut(links).select("*", valid.alias("_valid"), urls.is_root(F.col("_path")).alias("_root"))
    return flagged.select(
        "link",
        F.when(F.col("_valid"), F.col("primary_link")).alias("primary_link"),
        (F.col("_valid") & F.col("_root")).alias("is_homepage"),
        F.when(F.col("_valid") & ~F.col("_root"), F.col("_path")).alias("subsection"),
    )


def site_links(links: DataFrame) -> DataFrame:
    """Site and subsection of each non-empty link with a valid URL.

    Validity is tested on the link itself, ahead of the cutting: a filter on the
    finished site would be pushed below and drag all of the cutting along. Most
    links pass by the first pattern.
    """
    link = F.col("link")
    kept = links.where(urls.is_plain_url(link) | ((link != "") & urls.is_valid_odd_url(link)))
    section = F.when(~urls.is_root(F.col("_path")), F.col("_path"))
    # Never null from here on, and declared so: joins by site then add no null test,
    # which would split plans that should share one shuffle.
    site = F.coalesce("primary_link", F.lit(""))
    return _cut(kept).select(site.alias("primary_link"), section.alias("subsection"))


def site_counts(links: DataFrame) -> DataFrame:
    """Links per site: one shuffle, of partial counts."""
    return site_links(links).groupBy("primary_link").agg(F.count(F.lit(1)).alias("frequency"))


def site_sections(links: DataFrame) -> DataFrame:
    """Links per site and subsection (null for the home page).

    The shuffle is by both columns, so one big site is spread by its paths.
    """
    return (
        site_links(links)
        .groupBy("primary_link", "subsection")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def counts_of(sections: DataFrame) -> DataFrame:
    """Links per site from links per site and subsection."""
    return sections.groupBy("primary_link").agg(F.sum("links").alias("frequency"))


def site_table(links: DataFrame, parts: int | None = None) -> DataFrame:
    """Sites with their link count and distinct subsections as an array (null if none).

    One row a site. An array holds all of a site's paths in one task, so big inputs take
    ``site_counts`` and ``site_sections``, or ask for ``parts``: then every site alike has its
    subsections dealt by hash over as many rows (column ``part``; rows without links are
    left out), each with the links it counts, which add up to the site's.
    """
    keys = ["primary_link"]
    sections = site_sections(links)
    if parts is not None:
        part = F.coalesce(F.pmod(F.hash("subsection"), F.lit(parts)), F.lit(0))
        sections = sections.withColumn("part", F.when(F.col("subsection").isNull(), 0).otherwise(part))
        keys.append("part")
    collected = F.sort_array(F.collect_list("subsection"))
    return sections.groupBy(*keys).agg(
        F.sum("links").alias("frequency"), F.when(F.size(collected) > 0, collected).alias("subsections")
    )
