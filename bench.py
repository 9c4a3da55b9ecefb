"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from linklake.session import RECOMMENDED
from verification.queries import QUERIES

HEADLINE = [
    "site_frequency", "site_table", "enriched_site_table", "primary_link_projection", "clean_links",
    "links_by_category", "top_countries", "ad_based_ratio", "ad_domain_by_country", "category_coverage",
    "page_anchors", "page_links_union", "links_limited_per_file", "warc_site_counts",
    "warc_by_coordinates", "manifest_pick", "manifest_prefix_semi", "key_value_sum",
    "record_hook_sum", "link_file_roundtrip", "partitioned_sink_roundtrip", "stream_site_frequency",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        **RECOMMENDED,
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    # The JVM and the file footers are warmed by a query that is not timed.
    QUERIES["selection_count"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
