"""Inputs derived from the test tables.

Every recipe is SQL text that Spark and DuckDB both run, so the two sides of a
check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# One link a line item; the host ends in one of six suffixes.
LINKS = """
select concat(case when l_linenumber % 2 = 0 then 'http' else 'https' end,
  '://s', cast(l_suppkey as varchar(20)), '.example.',
  case when l_suppkey % 6 = 0 then 'com' when l_suppkey % 6 = 1 then 'fr'
       when l_suppkey % 6 = 2 then 'co.uk' when l_suppkey % 6 = 3 then 'de'
       when l_suppkey % 6 = 4 then 'zz' else 'jp' end,
  case when l_linenumber = 1 then '' when l_linenumber = 2 then '/'
       else concat('/', l_returnflag, '/', cast(l_linenumber as varchar(20)),
                   ';v=1?q=', l_linestatus) end) as link
from lineitem
"""

# Pages whose anchors are absolute.
HTML_PAGES = """
select page_id, url, replace(html, 'href="/', concat('href="https://n',
  cast(page_id % 7 as varchar(5)), '.site.', case when page_id % 3 = 0 then 'fr'
  when page_id % 3 = 1 then 'com' else 'de' end, '/')) as html
from pages
"""

# Archive paths, one an order, half of them of the partition that is looked for.
MANIFEST = """
select concat('crawl-data/CC-MAIN-', case when o_orderkey % 2 = 0 then '2025-13' else '2025-08' end,
  '/segments/', cast(o_custkey as varchar(20)), '.', cast(o_orderkey % 97 as varchar(20)),
  '/warc/', cast(o_orderkey as varchar(20)), '.warc.gz') as value
from orders
"""

# Country rows, one a supplier, some with two suffixes, quoted names or commas.
COUNTRY_LINES = """
select s_suppkey as pos, concat(
  case when s_suppkey % 3 = 0 then concat('"', s_name, ' (the)"')
       when s_suppkey % 3 = 1 then concat(s_name, ', the') else s_name end,
  ',C', cast(s_suppkey as varchar(20)), ',.t', cast(s_suppkey % 40 as varchar(20)),
  case when s_suppkey % 4 = 0 then concat('; .u', cast(s_suppkey as varchar(20))) else '' end) as value
from supplier
"""

# Lines of a hosts file, one a supplier: comments, blanks, short and mixed-case lines.
HOST_LINES = """
select case when s_suppkey % 7 = 0 then '# comment'
  when s_suppkey % 11 = 0 then '   '
  when s_suppkey % 13 = 0 then '0.0.0.0'
  else concat(' 0.0.0.0', chr(9), ' S', cast(s_suppkey as varchar(20)), '.Example.',
  case when s_suppkey % 6 = 4 then 'zz' else 'COM' end, ' # ads') end as value
from supplier
"""

# Category replies, one a supplier: none, one, or several with a tie.
CATEGORY_REPLIES = """
select concat('s', cast(s_suppkey as varchar(20)), '.example.',
  case when s_suppkey % 6 = 0 then 'com' when s_suppkey % 6 = 1 then 'fr'
       when s_suppkey % 6 = 2 then 'co.uk' when s_suppkey % 6 = 3 then 'de'
       when s_suppkey % 6 = 4 then 'zz' else 'jp' end) as domain,
  case when s_suppkey % 4 = 0 then '{"domainName":"x"}'
       when s_suppkey % 4 = 1 then '{"categories":[]}'
       when s_suppkey % 4 = 2 then concat('{"categories":[{"confidence":0.5,"id":1,"name":"News',
         cast(s_suppkey % 5 as varchar(5)), '"},{"confidence":0.9,"id":2,"name":"Sport"}]}')
       else concat('{"categories":[{"confidence":0.7,"id":3,"name":"Shop',
         cast(s_suppkey % 3 as varchar(5)), '"},{"confidence":0.7,"id":4,"name":"Travel"},',
         '{"confidence":0.1,"id":5,"name":"Music"}]}') end as reply
from supplier
"""


def rows(spark: SparkSession, sf_dir: str, table: str, recipe: str) -> DataFrame:
    """The rows of a recipe over one of the tables."""
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    text = recipe.replace("{", "{{").replace("}", "}}").replace(f"from {table}", "from {source}")
    return spark.sql(text, source=source)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, "lineitem", LINKS)


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, "pages", HTML_PAGES)


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record table from the pages: five archives, mixed types and headers."""
    page = F.col("page_id")
    http = F.when(page % 10 == 9, F.lit(None)).otherwise(
        F.create_map(
            F.lit("content-type"),
            F.when(page % 10 == 8, F.lit("application/json"))
            .when(page % 10 == 7, F.lit("Text/HTML"))
            .when(page % 10 == 6, F.lit("application/xhtml+xml"))
            .otherwise(F.lit("text/html; charset=utf-8")),
        )
    )
    warc = F.when(
        page % 20 == 8, F.create_map(F.lit("warc-identified-payload-type"), F.lit("text/html"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    return html_pages(spark, sf_dir).select(
        F.concat(F.lit("part-"), (page % 5).cast("string"), F.lit(".warc.gz")).alias("warc_file"),
        page.alias("record_pos"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("bigint").alias("length"),
        F.when(page % 6 == 5, F.lit("request"))
        .when(page % 6 == 4, F.lit("conversion"))
        .when(page % 6 == 3, F.lit("metadata"))
        .otherwise(F.lit("response"))
        .alias("rec_type"),
        F.when(page % 6 == 4, F.lit("text/plain"))
        .when(page % 6 == 3, F.lit("application/json"))
        .otherwise(F.lit("application/http; msgtype=response"))
        .alias("content_type"),
        F.col("url").alias("target_uri"),
        warc.alias("warc_headers"),
        http.alias("http_headers"),
        F.col("html").cast("binary").alias("payload"),
        F.lit(None).cast("string").alias("error"),
    )


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an HTML response record, five archives."""
    records = page_records(spark, sf_dir)
    return records.withColumn("rec_type", F.lit("response")).withColumn(
        "http_headers", F.create_map(F.lit("content-type"), F.lit("text/html"))
    )


def category_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linklake.sources.dimensions import parse_category_reply

    replies = rows(spark, sf_dir, "supplier", CATEGORY_REPLIES)
    return replies.select("domain", parse_category_reply(F.col("reply")).alias("categories"))


# Links with blanks, line breaks, quotes and commas, and some that are only dirt.
DIRTY_LINKS = """
select case when l_linenumber = 7 then concat(' ', chr(10), chr(9))
  when l_linenumber = 6 then '""'
  else concat(chr(9), ' https://s', cast(l_suppkey as varchar(20)), '.example.com/', chr(13), chr(10),
    l_returnflag, case when l_linenumber = 5 then ',x,"y"' else '' end, '/', chr(92), ' ', l_linestatus,
    case when l_linenumber = 4 then concat(',', chr(92)) else '' end, ' ') end as link
from lineitem
"""

# Links of which some are null, empty or no valid URL.
ODD_LINKS = """
select case when l_linenumber = 7 then null when l_linenumber = 6 then ''
  when l_linenumber = 5 then concat('http://[s', cast(l_suppkey as varchar(20)), '/x')
  else concat('http://s', cast(l_suppkey as varchar(20)), '.example.com/', l_returnflag) end as link
from lineitem
"""

# Page URLs with characters that need encoding.
ODD_URLS = """
select page_id, concat(url, '') as plain_url,
  concat(split_part(split_part(url, '?', 1), '#', 1), '/é b+c*~%20/(x)', chr(38), '|?q=é#f') as url
from pages
"""

SUFFIX_RULES = "('com'), ('fr'), ('uk'), ('co.uk'), ('de'), ('*.zz'), ('!example.zz'), ('example.jp')"

INDEX_QUERY = """
select page_id, url, cast(length(html) as bigint) as html_length
from page_index where length(html) > 0
"""
