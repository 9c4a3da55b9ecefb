"""The same results in DuckDB SQL, written without the library.

URLs of the test data have no user, port or brackets, so short RE2 patterns are
enough here; odd URLs and pages are compared with the standard library in tests.
"""

from __future__ import annotations

from linklake.sources.dimensions import COUNTRY_CODES
from verification import inputs

_SITE = "regexp_extract({0}, '^([a-z]+://[^/?#]*)', 1)"
_PATH = "regexp_replace(regexp_extract({0}, '^[a-z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
_SECTION = f"case when {_PATH} in ('', '/') then null else {_PATH} end"

_TLDS = ", ".join(
    [f"('.{code.lower()}', '{code}')" for code in COUNTRY_CODES.split()] + ["('.uk', 'GB')"]
)

_PARTS = f"""
l as ({inputs.LINKS}),
p as (select link, {_SITE.format('link')} as primary_link, {_SECTION.format('link')} as subsection from l)
"""
_SITES = f"""{_PARTS},
s as (select primary_link, count(*) as frequency,
  list_sort(list(distinct subsection) filter (where subsection is not null)) as sections
  from p group by primary_link)
"""
_ADS = f"""
h as (select distinct lower(f[2]) as host from (
  select string_split_regex(v, '\\s+') as f from (
    select regexp_replace(value, '^\\s+|\\s+$', '', 'g') as v from ({inputs.HOST_LINES}))
  where v <> '' and not starts_with(v, '#')) where len(f) >= 2)
"""
_CATEGORIES = """
c as (select concat('s', s_suppkey, '.example.', case s_suppkey % 6 when 0 then 'com' when 1 then 'fr'
    when 2 then 'co.uk' when 3 then 'de' when 4 then 'zz' else 'jp' end) as domain,
  case s_suppkey % 4 when 2 then 'Sport' when 3 then concat('Shop', s_suppkey % 3) end as category,
  cast(case s_suppkey % 4 when 2 then 2 when 3 then 3 else 0 end as integer) as entries
  from supplier)
"""
_ENRICHED = f"""
with {_SITES}, {_ADS}, {_CATEGORIES},
t(tld, code) as (values {_TLDS}),
e as (
  select s.primary_link, s.frequency, nullif(array_to_string(s.sections, chr(10)), '') as subsections,
    case when regexp_matches(s.primary_link, '\\.(com|org|net)$') then 'US' else t.code end as country_code,
    c.category,
    case when c.category is null then exists (
      select 1 from h where h.host = regexp_extract(s.primary_link, '//(.*)$', 1)) end as is_ad_domain
  from s
  left join t on t.tld = regexp_extract(s.primary_link, '(\\.[a-z]+)$', 1)
  left join c on c.domain = regexp_extract(s.primary_link, '//(.*)$', 1))
"""
_DIRTY = f"""
select link, count(*) as links from (
  select replace(replace(replace(trim(link, concat(' ', chr(9), chr(10), chr(13))), chr(10), ''), chr(13), ''), '"', '') as link
  from ({inputs.DIRTY_LINKS})) where link <> '' group by link
"""

# Anchors of a page in page order. Comments, scripts and styles of the test pages
# hold no anchors of their own once comments are taken out.
_ANCHORS = f"""
a as (
  select page_id, url,
    list_filter(list_transform(
      regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<a href="([^"]*)"', 1),
      lambda x: replace(replace(trim(x), '&amp;', '&'), '"', '')),
      lambda x: regexp_matches(x, '^https?://.')) as links
  from ({inputs.HTML_PAGES}))
"""
_MARKED = f"""
{_ANCHORS},
r as (
  select concat('part-', page_id % 5, '.warc.gz') as warc_file, page_id as record_pos, url, links,
    case page_id % 6 when 5 then 'request' when 4 then 'conversion' when 3 then 'metadata' else 'response' end as rec_type,
    page_id % 10 in (0, 1, 2, 3, 4, 5, 7) as html
  from a)
"""
_NUMBERED = """
select warc_file, record_pos, cast(0 as integer) as link_pos, url as link from {0}
union all
select warc_file, record_pos, cast(pos as integer) as link_pos, links[pos] as link
from (select *, unnest(generate_series(1, len(links))) as pos from {0}) where {1}
"""
_ALL_LINKS = f"with {_ANCHORS}, u as (select url as link from a union all select unnest(links) as link from a)"
_PATHS = f"""
m as (select value, regexp_extract(value,
  'crawl-data/CC-MAIN-2025-13/segments/[0-9]+\\.[0-9]+/.*\\.warc\\.gz', 0) as path from ({inputs.MANIFEST}))
"""

ORACLES = {
    "primary_link_projection": f"""
with {_PARTS}, u as (
  select link from l union all select url as link from pages)
select {_SITE.format('link')} as primary_link,
  {_PATH.format('link')} in ('', '/') as is_homepage, {_SECTION.format('link')} as subsection from u
""",
    "homepage_split": f"""
with {_PARTS}
select subsection is null as is_homepage, subsection, count(*) as links from p group by subsection
""",
    "clean_links": _DIRTY,
    "link_file_roundtrip": _DIRTY,
    "encode_url_path": f"""
select page_id, concat(
  regexp_extract(url, '^([a-z]+://[^/]*)', 1),
  replace(url_encode(regexp_extract(url, '^[a-z]+://[^/]*([^?#]*)', 1)), '%2F', '/'),
  regexp_extract(url, '(\\?.*)$', 1)) as encoded
from ({inputs.ODD_URLS})
""",
    "url_hosts": """
select page_id, lower(split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1)) as host,
  lower(split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1)) as fqdn from pages
""",
    "registered_suffix": f"""
with {_SITES}
select regexp_extract(primary_link, '//(.*)$', 1) as host,
  case regexp_extract(primary_link, '\\.([a-z]+)$', 1)
    when 'com' then 'com' when 'fr' then 'fr' when 'uk' then 'co.uk' when 'de' then 'de'
    when 'zz' then 'zz' when 'jp' then 'example.jp' end as suffix
from s
""",
    "site_frequency": f"with {_SITES} select primary_link, frequency from s",
    "stream_site_frequency": f"with {_SITES} select primary_link, frequency from s",
    "site_table": f"""
with {_SITES}
select primary_link, frequency, nullif(array_to_string(sections, chr(10)), '') as subsections from s
""",
    "site_table_in_parts": f"""
with {_SITES} select primary_link, frequency, unnest(sections) as subsection from s
""",
    "site_sections": f"""
with {_PARTS} select primary_link, subsection, count(*) as links from p group by primary_link, subsection
""",
    "site_country": f"{_ENRICHED} select primary_link, frequency, country_code from e",
    "site_category": f"{_ENRICHED} select primary_link, frequency, category from e",
    "ad_flag": f"{_ENRICHED} select primary_link, category, is_ad_domain from e",
    "ad_sites": f"""
with {_SITES}, {_ADS}
select primary_link, frequency from s
where regexp_extract(primary_link, '//(.*)$', 1) in (select host from h)
""",
    "enriched_site_table": f"{_ENRICHED} select * from e",
    "partitioned_sink_roundtrip": f"""
{_ENRICHED} select primary_link, frequency, country_code, category, is_ad_domain from e
""",
    "site_domains": f"""
with {_SITES} select distinct regexp_extract(primary_link, '//(.*)$', 1) as domain from s
""",
    "uncached_domains": f"""
with {_SITES}, {_CATEGORIES}
select distinct regexp_extract(primary_link, '//(.*)$', 1) as domain from s
where not exists (
  select 1 from c where entries > 0 and c.domain = regexp_extract(s.primary_link, '//(.*)$', 1))
""",
    "best_category": f"with {_CATEGORIES} select domain, category, entries from c",
    "country_dim": f"""
select tld, arg_max(code, pos * 10 + nth) as country_code from (
  select pos, code, unnest(generate_series(1, len(parts))) as nth, trim(unnest(parts)) as tld from (
    select pos, regexp_extract(value, '([^,]*),([^,]*)$', 1) as code,
      string_split(regexp_extract(value, '([^,]*),([^,]*)$', 2), ';') as parts
    from ({inputs.COUNTRY_LINES}))) group by tld
""",
    "ads_dim": f"with {_ADS} select host from h",
    "category_coverage": f"{_ENRICHED} select count(category) / count(*) as non_null_category_rate from e",
    "links_by_category": f"{_ENRICHED} select category, count(*) as link_count from e group by category",
    "weighted_links_by_category": f"""
{_ENRICHED} select category, cast(sum(frequency) as bigint) as link_count from e group by category
""",
    "top_countries": f"""
{_ENRICHED} select country_code, count(*) as cnt from e where country_code <> 'US'
group by country_code order by cnt desc, country_code limit 10
""",
    "ad_based_ratio": f"""
{_ENRICHED} select case when count(*) filter (where category is null) > 0
  then count(*) filter (where is_ad_domain) / count(*) filter (where category is null)
  else 0.0 end as ad_domain_ratio from e
""",
    "ad_domain_by_country": f"""
{_ENRICHED} select country_code, count(*) filter (where is_ad_domain) / count(*) as ad_based_ratio
from e group by country_code
""",
    "page_anchors": f"""
with {_ANCHORS}
select page_id as record_pos, cast(pos - 1 as integer) as link_pos, links[pos] as link
from (select *, unnest(generate_series(1, len(links))) as pos from a)
""",
    "page_links_union": f"""
with {_MARKED}, q as (select * from r where rec_type = 'response')
{_NUMBERED.format('q', 'html')}
""",
    "links_limited_per_page": f"with {_MARKED} {_NUMBERED.format('r', 'pos <= 2')}",
    "links_limited_per_file": f"""
with {_MARKED}, n as (select *, coalesce(sum(len(links)) over (
    partition by warc_file order by record_pos rows between unbounded preceding and 1 preceding), 0) as before
  from r), k as (select * from n where before < 50)
{_NUMBERED.format('k', 'pos + before <= 50')}
""",
    "html_records": """
select page_id as record_pos, page_id % 6 in (0, 1, 2) as is_response, page_id % 6 = 4 as is_text,
  page_id % 6 = 3 as is_json, page_id % 10 in (0, 1, 2, 3, 4, 5, 7) as declares_html,
  page_id % 10 in (0, 1, 2, 3, 4, 5, 6) or page_id % 20 = 8 as is_html
from pages
""",
    "warc_roundtrip": f"""
select url as target_uri, md5(html) as digest, octet_length(encode(html)) as bytes,
  cast(null as varchar) as error from ({inputs.HTML_PAGES})
""",
    "warc_in_stretches": f"""
select url as target_uri, md5(html) as digest, cast(null as varchar) as error from ({inputs.HTML_PAGES})
""",
    "warc_by_coordinates": f"""
select url, url as target_uri, 'response' as rec_type, md5(html) as digest from ({inputs.HTML_PAGES})
""",
    "warc_site_counts": f"""
with {_ANCHORS}, u as (select url as link from a union all select unnest(links) as link from a)
select {_SITE.format('link')} as primary_link, count(*) as frequency from u group by 1
""",
    "pipeline_sites": f"""
with {_ANCHORS}, u as (select url as link from a union all select unnest(links) as link from a)
select {_SITE.format('link')} as primary_link, count(*) as frequency from u group by 1
""",
    "pipeline_sections": f"""
with {_ANCHORS}, u as (select url as link from a union all select unnest(links) as link from a)
select {_SITE.format('link')} as primary_link, {_SECTION.format('link')} as subsection, count(*) as links from u group by 1, 2
""",
    "pipeline_metrics": f"""
with {_ANCHORS}, u as (select url as link from a union all select unnest(links) as link from a),
d as (select distinct {_SITE.format('link')} as site from u),
t(tld, code) as (values {_TLDS})
select code as country_code, count(*) as cnt
from d join t on t.tld = regexp_extract(site, '(\\.[a-z]+)$', 1)
where not regexp_matches(site, '\\.(com|org|net)$') and code <> 'US' group by code order by cnt desc, country_code limit 10
""",
    "manifest_paths": f"with {_PATHS} select distinct path from m where path <> ''",
    "manifest_pick": f"with {_PATHS} select distinct path from m where path <> '' order by path limit 3",
    "manifest_prefix_semi": f"""
with {_PATHS}, k as (select distinct path from m where path <> '' order by path limit 7)
select value from m where exists (select 1 from k where starts_with(m.value, k.path))
""",
    "key_value_sum": """
select word as key, count(*) as val from (
  select unnest(string_split(text, ' ')) as word from documents) group by word
""",
    "key_value_max": "select source as key, max(length(text)) as val from documents group by source",
    "record_hook_sum": f"""
select case page_id % 6 when 5 then 'request' when 4 then 'conversion' when 3 then 'metadata'
    else 'response' end as key, cast(sum(octet_length(encode(html))) as bigint) as val
from ({inputs.HTML_PAGES}) group by 1
""",
    "archive_job_table": f"""
select regexp_extract(url, '^([a-z]+)', 1) as key, cast(sum(octet_length(encode(html))) as bigint) as val
from ({inputs.HTML_PAGES}) group by 1
""",
    "index_job_table": inputs.INDEX_QUERY.replace("page_index", "pages"),
    "index_record_job_table": f"""
select regexp_extract(url, '^([a-z]+)', 1) as key, max(octet_length(encode(html))) as val
from ({inputs.HTML_PAGES}) group by 1
""",
    "job_counters": """
select count(*) as inputs, count(*) as records, cast(0 as bigint) as failed from pages
""",
    "link_table_roundtrip": f"with {_PARTS} select link, 2 * count(*) as links from l group by link",
    "index_sql_select": inputs.INDEX_QUERY.replace("page_index", "pages"),
    "selection_count": f"select count(*) as matched from ({inputs.INDEX_QUERY.replace('page_index', 'pages')})",
    "stream_archive_links": f"{_ALL_LINKS} select link, count(*) as links from u group by link",
    "stream_counts_compacted": f"with {_SITES} select primary_link, frequency from s",
    "category_cache_rounds": f"""
with {_SITES}, {_CATEGORIES}, d as (select distinct regexp_extract(primary_link, '//(.*)$', 1) as domain from s)
select d.domain, c.category, 1 as rounds_asked from d left join c using (domain)
""",
    "links_limited_early": "select cast(0 as bigint) as differences, true as stopped_early",
    "listed_archives_cut": f"""
select url as target_uri, md5(html) as digest, false as failed from ({inputs.HTML_PAGES})
union all select null, null, true
""",
    "coordinates_csv": f"select url, url as target_uri, md5(html) as digest from ({inputs.HTML_PAGES})",
    "hook_with_index_row": f"""
select regexp_extract(url, '^([a-z]+)', 1) as scheme, true as placed, count(*) as records,
  cast(sum(octet_length(encode(html))) as bigint) as bytes from ({inputs.HTML_PAGES}) group by 1
""",
    "job_with_own_schema": f"""
select split_part(url, '/', 3) as host, cast(sum(octet_length(encode(html))) as double) as val
from ({inputs.HTML_PAGES}) group by 1
""",
    "link_table_ids": """
select unnest([1, 2]) as load, n as links, n as ids, n as span from (select count(*) as n from lineitem)
""",
    "links_of_several_folders": f"""
with {_PARTS} select link, count(*) * case when link like 'https%' then 2 else 1 end as links from l group by link
""",
    "table_in_files": f"""
with {_SITES} select true as few_files, count(*) as sites, cast(sum(frequency) as bigint) as links from s
""",
    "selection_used_twice": f"""
select count(*) as matched, max(html_length) as longest from ({inputs.INDEX_QUERY.replace('page_index', 'pages')})
""",
    "manifest_from_file": f"with {_PATHS} select distinct path from m where path <> ''",
    "odd_links_by_site": f"""
with o as ({inputs.ODD_LINKS})
select {_SITE.format('link')} as primary_link, count(*) as frequency from o where link like 'http://s%' group by 1
union all select '(stored)', count(link) from o
""",
    "pipeline_metric_files": f"""
{_ALL_LINKS}, {_CATEGORIES}, t(tld, code) as (values {_TLDS}),
d as (select distinct {_SITE.format('link')} as site from u),
e as (
  select case when regexp_matches(site, '\\.(com|org|net)$') then 'US' else t.code end as country, c.category
  from d left join t on t.tld = regexp_extract(site, '(\\.[a-z]+)$', 1)
  left join c on c.domain = regexp_extract(site, '//(.*)$', 1))
select 'category_coverage' as metric, cast(null as varchar) as key, count(category) / count(*) as value from e
union all select 'links_by_category', category, cast(count(*) as double) from e group by category
union all (select 'top_countries', country, cast(count(*) as double) from e where country <> 'US'
  group by country order by count(*) desc, country limit 10)
union all select 'ad_based_ratio', null, 0.0
union all select 'ad_domain_by_country', country, 0.0 from e group by country
""",
    "payload_charsets": """
select doc_id, md5(case doc_id % 5 when 0 then concat(text, chr(65533), chr(65533))
  when 2 then regexp_replace(text, '[^\\x00-\\x7f]', repeat(chr(65533), 2), 'g') else text end) as digest
from documents
""",
}
