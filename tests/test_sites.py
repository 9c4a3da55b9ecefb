from pyspark.sql import functions as F

from linklake.operators import enrich, sites
from linklake.sources import dimensions


def links(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "link string")


SOME = [
    "http://a.com", "http://a.com/", "http://a.com/x", "http://a.com/x?q", "http://a.com/y", "https://a.com/x",
    "http://[bad/", "", None, "HTTP://b.org/",
]


def test_site_table(spark):
    got = {r.primary_link: (r.frequency, r.subsections) for r in sites.site_table(links(spark, *SOME)).collect()}
    assert got == {
        "http://a.com": (5, ["/x", "/y"]), "https://a.com": (1, ["/x"]), "http://b.org": (1, None)
    }


def test_site_table_equals_its_join_form(spark):
    cut = sites.site_links(links(spark, *SOME))
    counts = cut.groupBy("primary_link").agg(F.count(F.lit(1)).alias("frequency"))
    sections = (
        cut.where(F.col("subsection").isNotNull()).groupBy("primary_link")
        .agg(F.sort_array(F.collect_set("subsection")).alias("subsections"))
    )
    joined = counts.join(sections, "primary_link", "left")
    table = sites.site_table(links(spark, *SOME))
    assert sorted(map(str, joined.collect())) == sorted(map(str, table.collect()))


def test_big_sites_are_spread_whole(spark):
    many = [f"http://big.com/{i}" for i in range(200)] * 2 + ["http://big.com/"] * 3 + ["http://small.com/1"]
    rows = sites.site_table(links(spark, *many), parts=10).collect()
    big = [r for r in rows if r.primary_link == "http://big.com"]
    assert sorted(r.part for r in big) == list(range(10))
    assert sum(r.frequency for r in big) == 403
    assert sorted(s for r in big for s in r.subsections) == sorted(f"/{i}" for i in range(200))
    assert [tuple(r)[2:] for r in rows if r.primary_link == "http://small.com"] == [(1, ["/1"])]
    assert [r.frequency for r in sites.site_table(links(spark, *many)).collect() if len(r.subsections) > 1] == [403]


def test_one_shuffle_of_partial_counts(spark):
    plan = sites.site_counts(links(spark, *SOME))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "partial_count" in plan


def country(spark, *hosts, tlds=None):
    table = spark.createDataFrame([(f"http://{h}", 1) for h in hosts], "primary_link string, frequency long")
    found = enrich.add_country(table, dimensions.country_tlds(spark) if tlds is None else tlds)
    assert found.columns == ["primary_link", "frequency", "country_code"]
    codes = {r.primary_link[7:]: r.country_code for r in found.collect()}
    return [codes[h] for h in hosts]


def test_country(spark):
    assert dimensions.country_tlds(spark).count() == 197
    hosts = ["a.co.uk", "a.GB", "a.ps:80", "a.tz", "a.na", "a.zz", "1.2.3.4", "a.COM", "a.org", "a.net", "[::1]", "u@a.fr."]
    assert country(spark, *hosts) == ["GB", "GB", "PS", "TZ", "NA", None, None, "US", "US", "US", None, "FR"]


def test_country_file_is_repaired(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'name,code,tld\nNamibia,NA,.na\nPalestine, State of,PS,.ps\n"United (the)",GB,.gb; .uk\nOther,XX,.na\n'
    )
    rows = {tuple(r) for r in dimensions.read_country_tlds(spark, str(tmp_path / "t.csv")).collect()}
    assert rows == {(".na", "XX"), (".ps", "PS"), (".gb", "GB"), (".uk", "GB")}
    assert country(spark, "a.ps", "a.uk", tlds=dimensions.read_country_tlds(spark, str(tmp_path / "t.csv"))) == ["PS", "GB"]


def test_ad_hosts(spark, tmp_path):
    (tmp_path / "hosts").write_text("# c\n\n 0.0.0.0\tAd.Example.com # x\n127.0.0.1\n0.0.0.0 ad.example.com\n0.0.0.0 b.net\n")
    hosts = dimensions.read_ad_hosts(spark, str(tmp_path / "hosts"))
    assert sorted(r.host for r in hosts.collect()) == ["ad.example.com", "b.net"]
    assert dimensions.read_ad_hosts(spark, str(tmp_path / "none")).count() == 0
    table = spark.createDataFrame(
        [("http://AD.example.com:80", None), ("http://b.net", "News"), ("http://c.net", None)],
        "primary_link string, category string",
    )
    flags = {r.primary_link: r.is_ad_domain for r in enrich.add_ad_flag(table, hosts).collect()}
    assert flags == {"http://AD.example.com:80": True, "http://b.net": None, "http://c.net": False}
    only = enrich.only_ad_sites(table, hosts).collect()
    assert sorted(r.primary_link for r in only) == ["http://AD.example.com:80", "http://b.net"]


def test_categories(spark):
    replies = [
        ("a.com", '{"categories":[{"confidence":0.9,"id":1,"name":"First"},{"confidence":0.9,"id":2,"name":"Second"}]}'),
        ("b.com", '{"categories":[]}'), ("c.com", "{}"), ("d.com", None), ("e.com", "not json"),
        ("f.com", '{"categories":[{"confidence":1,"id":1,"name":"Low"},{"confidence":2,"id":2,"name":"High"}]}'),
        ("f.com", '{"categories":[{"confidence":1.5,"id":3,"name":"Middle"}]}'),
    ]
    frame = spark.createDataFrame(replies, "domain string, reply string").select(
        "domain", dimensions.parse_category_reply(F.col("reply")).alias("categories")
    )
    table = dimensions.category_table(frame)
    assert {tuple(r) for r in table.collect()} == {
        ("a.com", "First"), ("b.com", None), ("c.com", None), ("d.com", None), ("e.com", None), ("f.com", "High")
    }
    hosted = spark.createDataFrame([("http://A.com",), ("http://f.com:1",), ("http://z.com",), ("http://1.2.3.4",)], "primary_link string")
    found = {r.primary_link: r.category for r in enrich.add_category(hosted, table).collect()}
    assert found == {"http://A.com": "First", "http://f.com:1": "High", "http://z.com": None, "http://1.2.3.4": None}
    unknown = enrich.unknown_domains(enrich.site_domains(hosted), table)
    assert [r.domain for r in unknown.collect()] == ["z.com"]


def test_suffix_rules(spark):
    rules = spark.createDataFrame([("com",), ("uk",), ("co.uk",), ("*.ck",), ("!www.ck",)], "rule string")
    want = {"a.b.co.uk": "co.uk", "a.uk": "uk", "x.y.ck": "y.ck", "www.ck": "ck", "a.www.ck": "ck", "a.zz": None, "": None, "com": "com"}
    hosts = spark.createDataFrame([(h,) for h in want] * 2, "host string")
    got = enrich.add_registered_domain(hosts, rules).collect()
    assert len(got) == 2 * len(want) and {r.host: r.suffix for r in got} == want
