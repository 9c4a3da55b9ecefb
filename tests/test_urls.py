import random
from urllib.parse import quote, urlparse, urlunparse

from conftest import column
from pyspark.sql import functions as F

from linklake.functions import urls
from linklake.operators import sites

EDGES = [
    "http://a.com", "http://a.com/", "http://a.com//", "http://a.com?x=1", "http://a.com/;x",
    "http://a.com/x;p=1/y;q;z?k=1#f", "HTTP://User@A.Com:80/x y|z", "http:///p", "http://[::1]/p",
    "http://[bad/", "  http://a.com/p", "ht\ttp://a.com/p\nq", "dns:a.com", "//a.com/p", "a/b", "",
    "http://[::ffff:1.2.3.4]/", "http://[1::2:3]x/", "http://[1.2.3.4]/", "http://[v1.x]/",
    "http://a／b.com/", "http://℀.com/", "http://a.com/[x]", "http://]x[::1/p", "data:text/html;a",
]
PIECES = [
    "http://", "https://", "HTTP://", "ftp:", "a.com", "/", "//", "?", ";", "#", "x=1", "[::1]", "[", "]",
    "[1::2:3]", "[::ffff:1.2.3.4]", "[v1.a]", "@", ":80", " ", "\t", "\n", "|", "é", "／", "℀",
    "%20", "*", "~", "+", "User", "..", "dns:", "mailto:a", "\x1f",
]


def expected(link):
    try:
        parsed = urlparse(link)
    except ValueError:
        return None, False, None, None
    home = parsed.path in ("", "/")
    rebuilt = urlunparse(
        (parsed.scheme, parsed.netloc, quote(parsed.path), parsed.params, parsed.query, parsed.fragment)
    )
    return f"{parsed.scheme}://{parsed.netloc}", home, None if home else parsed.path, rebuilt


def test_parts_equal_the_standard_library(spark):
    rnd = random.Random(11)
    made = ["".join(rnd.choices(PIECES, k=rnd.randint(1, 8))) for _ in range(3000)]
    made += ["http://" + "".join(rnd.choices(PIECES, k=rnd.randint(1, 6))) for _ in range(3000)]
    links = spark.createDataFrame([(link,) for link in EDGES + made], "link string")
    link = F.col("link")
    got = links.select(
        "link", urls.primary_link(link), urls.is_homepage(link), urls.subsection(link), urls.encode_url_path(link)
    ).collect()
    assert [tuple(r[1:]) for r in got] == [expected(r[0]) for r in got]
    staged = sites.link_parts(links).collect()
    assert [tuple(r[1:]) for r in staged] == [expected(r[0])[:3] for r in staged]


def test_plain_links_are_valid(spark):
    found = column(spark, EDGES, urls.is_plain_url(F.col("v")) & ~urls.is_valid_url(F.col("v")))
    assert not any(found)


def test_host(spark):
    hosts = {
        "http://user:pw@WWW.A.com:80/x": "www.a.com", "http://a.com./": "a.com", "http://[::1]:8080/": "[::1]",
        "http://a。com/": "a.com", "http://": "", "http://[bad/": None, "http://h@x@b.org?q": "b.org",
    }
    assert column(spark, list(hosts), urls.host(F.col("v"))) == list(hosts.values())


def test_fqdn_and_label(spark):
    names = {"a.co.uk": "a.co.uk", "localhost": None, "1.2.3.4": None, "[::1]": None, "": None}
    assert column(spark, list(names), urls.fqdn(F.col("v"))) == list(names.values())
    labels = {"a.co.UK": ".uk", "com": ".com", ".fr": ".fr"}
    got = column(spark, list(labels), urls.dotted(urls.last_label(F.col("v"))))
    assert got == list(labels.values())
