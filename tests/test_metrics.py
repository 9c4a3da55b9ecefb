import pytest
from pyspark.sql import functions as F

from linklake.operators import metrics

SCHEMA = "primary_link string, frequency long, country_code string, category string, is_ad_domain boolean"


def computed(spark, rows, weight=None):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {n: [tuple(r) for r in t.collect()] for n, t in metrics.compute_metrics(frame, weight).items()}


ROWS = [
    ("a", 5, "FR", "News", None), ("b", 1, "FR", None, True), ("c", 2, None, None, False),
    ("d", 3, "US", "News", None), ("e", 9, "DE", None, True),
]


def test_metrics(spark):
    got = computed(spark, ROWS)
    assert list(got) == ["category_coverage", "links_by_category", "top_countries", "ad_based_ratio", "ad_domain_by_country"]
    assert got["category_coverage"] == [(0.4,)]
    assert got["links_by_category"] == [(None, 3), ("News", 2)]
    assert got["top_countries"] == [("FR", 2), ("DE", 1)]
    assert got["ad_based_ratio"] == [(2 / 3,)]
    assert set(got["ad_domain_by_country"]) == {("FR", 0.5), (None, 0.0), ("US", 0.0), ("DE", 1.0)}


def test_weighted(spark):
    got = computed(spark, ROWS, "frequency")
    assert got["links_by_category"] == [(None, 12), ("News", 8)]
    assert got["top_countries"] == [("DE", 9), ("FR", 6)]


def test_empty_and_all_categorised(spark):
    assert computed(spark, []) == {
        "category_coverage": [(None,)], "links_by_category": [], "top_countries": [], "ad_based_ratio": [(0.0,)],
        "ad_domain_by_country": [],
    }
    assert computed(spark, [("a", 1, "FR", "News", None)])["ad_based_ratio"] == [(0.0,)]


def test_ties_at_the_last_place(spark):
    rows = [(f"s{i}", 1, f"C{i:02d}", None, False) for i in range(15)]
    assert computed(spark, rows)["top_countries"] == [(f"C{i:02d}", 1) for i in range(10)]


def test_sites_in_parts_are_refused(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).withColumn("part", F.lit(0))
    with pytest.raises(ValueError, match="one row a site"):
        metrics.compute_metrics(frame)
