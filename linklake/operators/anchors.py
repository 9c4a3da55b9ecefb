"""Links of archive records: the page URL and its anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linklake.functions.html import anchor_links
from linklake.functions.records import declares_html, is_response
from linklake.functions.text import clean_link, decode_utf8, is_nonempty

# Records of one archive that share a window group when links are limited.
RECORDS_PER_BLOCK = 16_384


def page_anchors(records: DataFrame, html: Column | None = None, limit: int | None = None) -> DataFrame:
    """Response records with ``page_url`` and the ``anchors`` of HTML pages.

    Other media types keep their URL and have no anchors. ``limit`` keeps the
    first anchors of each page.
    """
    text = decode_utf8(F.col("payload")) if html is None else html
    none = F.array().cast("array<string>")
    anchors = F.when(declares_html(F.col("http_headers")), anchor_links(text)).otherwise(none)
    if limit:
        anchors = F.slice(anchors, 1, limit)
    return records.where(is_response(F.col("rec_type"))).select(
        "warc_file",
        "record_pos",
        clean_link(F.coalesce("target_uri", F.lit(""))).alias("page_url"),
        anchors.alias("anchors"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Page URL (``link_pos`` 0) and anchors (from 1) in one pass, no union."""
    both = F.concat(F.array("page_url"), "anchors")
    links = pages.select("warc_file", "record_pos", F.posexplode(both).alias("link_pos", "link"))
    return links.where(is_nonempty(F.col("link")))


def limit_per_archive(pages: DataFrame, limit: int) -> DataFrame:
    """Pages cut so that each archive gives its first ``limit`` anchors.

    Reading an archive stops at its limit, so later page URLs go too. The count of
    anchors before a page is the count before its block of records plus the count
    inside the block; windows never hold more than a block of records, and only
    one small row a block is ordered over a whole archive. Give it a stored table:
    it is read twice.
    """
    block = F.floor(F.col("record_pos") / RECORDS_PER_BLOCK).alias("block")
    counted = pages.select("*", block, F.size("anchors").alias("count"))
    earlier_blocks = Window.partitionBy("warc_file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before_block = (
        counted.groupBy("warc_file", "block")
        .agg(F.sum("count").alias("block_count"))
        .select(
            "warc_file",
            "block",
            F.coalesce(F.sum("block_count").over(earlier_blocks), F.lit(0)).alias("before_block"),
        )
        .where(F.col("before_block") < limit)
    )
    earlier_records = Window.partitionBy("warc_file", "block").orderBy("record_pos").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.col("before_block") + F.coalesce(F.sum("count").over(earlier_records), F.lit(0))
    return (
        counted.join(before_block, ["warc_file", "block"])
        .withColumn("before", before)
        .where(F.col("before") < limit)
        .select(
            "warc_file",
            "record_pos",
            "page_url",
            F.slice("anchors", F.lit(1), (F.lit(limit) - F.col("before")).cast("int")).alias("anchors"),
        )
    )
