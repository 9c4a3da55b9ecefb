"""Country, category and ad flag of sites.

All three are left joins of a site table with a small side: one row a key on the
right, so no site is lost or doubled. A side under Spark's broadcast threshold is
broadcast; a bigger one is shuffled and hot keys are split by the adaptive skew
join, which may split the left side of a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.functions import urls


def with_host(sites: DataFrame) -> DataFrame:
    """Sites with their host in a column of its own, worked out once a site.

    It is never null, so joins by host add no null test. Spark would push such a
    test below the grouping of the links and work the host out for every link.
    """
    if "_host" in sites.columns:
        return sites
    host = F.coalesce(urls.site_host(F.col("primary_link")), F.lit(""))
    return sites.withColumn("_host", host)


def add_country(sites: DataFrame, tlds: DataFrame) -> DataFrame:
    """``country_code`` from the last label of the host; null if unknown."""
    # One row a suffix, whatever the table holds, so no site is doubled.
    lookup = tlds.groupBy(F.lower("tld").alias("_tld")).agg(F.min("country_code").alias("_code"))
    keyed = with_host(sites).withColumn("_label", urls.last_label(F.col("_host")))
    keyed = keyed.withColumn("_tld", urls.dotted(F.col("_label")))
    code = F.when(F.col("_label").isin(urls.US_SUFFIXES), F.lit("US")).otherwise(F.col("_code"))
    joined = keyed.join(lookup, "_tld", "left").withColumn("country_code", code)
    return joined.drop("_tld", "_label", "_code", *_added(sites))


def _added(sites: DataFrame) -> list[str]:
    """The working column to drop again, unless the caller brought it."""
    return [] if "_host" in sites.columns else ["_host"]


def add_registered_domain(hosts: DataFrame, suffix_rules: DataFrame) -> DataFrame:
    """``suffix`` of each ``host`` by a table of suffix rules (column ``rule``).

    Rules are plain (``co.uk``), wildcard (``*.ck``) or exceptions (``!www.ck``);
    an exception wins, else the longest match. Every host offers its own label
    suffixes as keys of one equi-join.
    """
    labels = F.split("host", r"\.")
    # The outer form: the plain one adds a size test that is pushed below distinct.
    start = F.explode_outer(F.sequence(F.lit(1), F.size("_labels")))
    offered = (
        hosts.select("host").distinct()
        .withColumn("_labels", labels)
        .select("host", "_labels", start.alias("_from"))
    )

    def tail(skip: int):
        part = F.slice("_labels", F.col("_from") + skip, F.size("_labels"))
        return F.array_join(part, ".")

    count = F.size("_labels") - F.col("_from") + 1
    def key(rule, suffix, exception: int, size):
        return F.struct(
            rule.alias("rule"),
            suffix.alias("suffix"),
            F.lit(exception).alias("exception"),
            size.alias("labels"),
        )

    kinds = F.array(
        key(tail(0), tail(0), 0, count),
        key(F.concat(F.lit("*."), tail(1)), tail(0), 0, count),
        key(F.concat(F.lit("!"), tail(0)), tail(1), 1, count - 1),
    )
    keys = offered.select("host", F.inline(kinds))
    matched = keys.join(suffix_rules.select("rule").distinct(), "rule")
    best = matched.groupBy("host").agg(F.max(F.struct("exception", "labels", "suffix")).alias("best"))
    return hosts.join(best.select("host", F.col("best.suffix").alias("suffix")), "host", "left")


def site_domains(sites: DataFrame) -> DataFrame:
    """Distinct full domain names of the sites, as ``domain``.

    Sites without one fall into the null group, which is told by its count: a
    null test would be pushed below the grouping of the links.
    """
    domain = urls.fqdn(F.col("_host")).alias("domain")
    grouped = with_host(sites).select(domain).groupBy("domain").agg(F.count("domain").alias("named"))
    return grouped.where(F.col("named") > 0).select("domain")


def unknown_domains(domains: DataFrame, known: DataFrame) -> DataFrame:
    """Domains with no entry yet. An entry with a null category counts as known:
    a domain nothing was found for is not asked again."""
    return domains.join(known.select("domain"), "domain", "left_anti")


def add_category(sites: DataFrame, categories: DataFrame) -> DataFrame:
    """``category`` by full domain name, from ``domain, category``; of several rows of
    a domain the least category that is not null stands."""
    lookup = categories.groupBy(F.lower("domain").alias("_domain")).agg(F.min("category").alias("category"))
    keyed = with_host(sites).withColumn("_domain", urls.fqdn(F.col("_host")))
    return keyed.join(lookup, "_domain", "left").drop("_domain", *_added(sites))


def add_ad_flag(sites: DataFrame, ad_hosts: DataFrame) -> DataFrame:
    """``is_ad_domain`` of sites without a category; null for the others."""
    lookup = ad_hosts.select(F.lower("host").alias("_host")).distinct().withColumn("_hit", F.lit(True))
    flag = F.when(F.col("category").isNull(), F.coalesce("_hit", F.lit(False)))
    joined = with_host(sites).join(lookup, "_host", "left").withColumn("is_ad_domain", flag)
    return joined.drop("_hit", *_added(sites))


def only_ad_sites(sites: DataFrame, ad_hosts: DataFrame) -> DataFrame:
    """Sites whose host is an ad host.

    An inner join with distinct hosts: a semi join would be pushed below the
    grouping of the links and look every link up.
    """
    lookup = ad_hosts.select(F.lower("host").alias("_host")).distinct()
    return with_host(sites).join(lookup, "_host").drop(*_added(sites))


def enrich(sites: DataFrame, tlds: DataFrame, categories: DataFrame, ad_hosts: DataFrame) -> DataFrame:
    """All three, with the host worked out once."""
    hosted = add_country(with_host(sites), tlds)
    return add_ad_flag(add_category(hosted, categories), ad_hosts).drop("_host")
