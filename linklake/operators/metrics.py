"""Metric tables of an enriched site table.

Metrics count sites, one row each. With ``weight="frequency"`` they sum link counts instead
where a count of links makes sense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.storage import written

TOP_COUNTRIES = 10


def totals(sites: DataFrame, weight: str | None = None) -> DataFrame:
    """Everything the metrics need, in one pass: a row for each category and country.

    ``n`` counts sites, ``amount`` what ``weight`` says, ``ads`` ad sites. Each metric is
    a sum over some of these few rows, so one narrow aggregate stands for five.
    """
    amount = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")
    return sites.groupBy("category", "country_code").agg(
        F.count(F.lit(1)).alias("n"), amount.alias("amount"), F.count_if("is_ad_domain").alias("ads")
    )


def _category_coverage(rows: DataFrame) -> DataFrame:
    rate = F.try_divide(F.sum(F.when(F.col("category").isNotNull(), F.col("n")).otherwise(0)), F.sum("n"))
    return rows.agg(rate.alias("non_null_category_rate"))


def _links_by_category(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.sum("amount").alias("link_count")).orderBy(F.desc("link_count"), "category")


def _top_countries(rows: DataFrame, count: int = TOP_COUNTRIES) -> DataFrame:
    counted = rows.where(F.col("country_code") != "US").groupBy("country_code").agg(F.sum("amount").alias("cnt"))
    return counted.orderBy(F.desc("cnt"), "country_code").limit(count)


def _ad_based_ratio(rows: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.sum("ads"), F.sum(F.when(F.col("category").isNull(), F.col("n"))))
    return rows.agg(F.coalesce(ratio, F.lit(0.0)).alias("ad_domain_ratio"))


def _ad_domain_by_country(rows: DataFrame) -> DataFrame:
    return rows.groupBy("country_code").agg((F.sum("ads") / F.sum("n")).alias("ad_based_ratio"))


def category_coverage(sites: DataFrame) -> DataFrame:
    return _category_coverage(totals(sites))


def links_by_category(sites: DataFrame, weight: str | None = None) -> DataFrame:
    return _links_by_category(totals(sites, weight))


def top_countries(sites: DataFrame, count: int = TOP_COUNTRIES, weight: str | None = None) -> DataFrame:
    """The biggest countries other than US; unknown ones are not ranked."""
    return _top_countries(totals(sites, weight), count)


def ad_based_ratio(sites: DataFrame) -> DataFrame:
    """Ad sites over sites without a category; 0.0 if there are none."""
    return _ad_based_ratio(totals(sites))


def ad_domain_by_country(sites: DataFrame) -> DataFrame:
    return _ad_domain_by_country(totals(sites))


def compute_metrics(sites: DataFrame, weight: str | None = None) -> dict[str, DataFrame]:
    """The five metric tables from one scan of the sites.

    The totals are worked out and stored at once; the tables read these few rows.
    """
    if "part" in sites.columns:
        raise ValueError("metrics take one row a site, not sites in parts")
    rows = written(totals(sites, weight), "metric-totals")
    return {
        "category_coverage": _category_coverage(rows),
        "links_by_category": _links_by_category(rows),
        "top_countries": _top_countries(rows),
        "ad_based_ratio": _ad_based_ratio(rows),
        "ad_domain_by_country": _ad_domain_by_country(rows),
    }
