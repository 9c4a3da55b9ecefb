import html
import random
import time
from html.parser import HTMLParser

import pytest
from conftest import column
from pyspark.sql import functions as F

from linklake.functions import html as page
from linklake.functions.text import clean_link, has_clean_text

TOKENS = [
    "<a ", "<A\n", "<a", "<abbr ", "href=", "HREF = ", "href", "data-href=", '"http://x.com/?a=1&amp;b"',
    "'http://y.com'", "http://z.com/p", " ", ">", "/>", "</a>", "text", "<!--", "-->", "<!-- c -->", "<script>",
    "</script>", "<script src='x'>", "<script/>", "<style>", "</style >", "<![CDATA[", "]]>", "<!doctype html>",
    "<?pi", "</", "<", "=", '"', "'", "class=b", "&lt;a href='http://no'>", "\n",
    "<p title='<a href=\"http://in.com\">'>", 'title="a>b"', "<div", "/", "<!x", '<a href="http://q.com">',
    "<a href='http://r.com/a,b'>", "\x0b", " ", "<b>", "1",
]
REFERENCES = [
    "&amp;", "&amp", "&lt", "&quot;", "&copy", "&copyx", "&notit;", "&notin;", "&#65;", "&#x41", "&#0;", "&#128;",
    "&#x9f;", "&#xD800;", "&#1114112;", "&#99999999999;", "&#11;", "&#xFFFE;", "&", "&;", "& ", "a", "=1", "&#",
    "&#x", "&fjlig;", "&bne;", "&nosuch;", "&Eacute", "é", "&hellip;", "&ampamp;", "&frac12x", "&#x1F600;",
    "&#13;", "&#xfdd0;", "&#x80;", "&#129;",
]


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found = []

    def handle_starttag(self, tag, attrs):
        values = {name: value or "" for name, value in attrs}
        if tag == "a" and "href" in values:
            self.found.append(values["href"])


def parsed(text):
    anchors = Anchors()
    anchors.feed(text)
    anchors.close()
    return anchors.found


def test_anchors_equal_the_standard_parser(spark):
    rnd, texts, want = random.Random(3), [], []
    while len(texts) < 8000:
        text = "".join(rnd.choices(TOKENS, k=rnd.randint(1, 25)))
        try:
            want.append(parsed(text))
        except AssertionError:  # the parser gives up on some marked sections
            continue
        texts.append(text)
    assert column(spark, texts, page.anchor_hrefs(F.col("v"))) == want
    assert sum(map(len, want)) > 1000


def test_references_equal_the_standard_library(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices(REFERENCES, k=rnd.randint(1, 6))) for _ in range(3000)]
    assert column(spark, texts, page.unescape(F.col("v"))) == [html.unescape(t) for t in texts]


def test_links_are_filtered_and_cleaned(spark):
    text = (
        '<a href="http://">x</a><a href="https://">x</a><a href="/rel">x</a><a href="HTTP://A.com">x</a>'
        '<A HREF=" http://b.com">x</A><a href="http://c.com/a,b&quot;\n ">x</a><a href=http://d.com>x</a>'
        '<a href="ftp://e.com">x</a><a href="http://f.com" href="http://g.com">x</a>'
        '<!-- <a href="http://h.com"> --><script>"<a href=\'http://i.com\'>"</script><a href="http://d.com">x</a>'
    )
    got = column(spark, [text], page.anchor_links(F.col("v")))[0]
    assert got == ["http://c.com/a,b", "http://d.com", "http://g.com", "http://d.com"]


def test_long_pages_do_not_overflow(spark):
    big = [
        "<p " + "a=1 " * 200_000 + '><a href="http://x.com">' + "<!-- c -->" * 50_000,
        "<!--" + "-" * 500_000, "<script>" + "x<y " * 200_000, '<a title="' + "q" * 1_000_000 + '" href=http://y.com>',
    ]
    got = column(spark, big, page.anchor_links(F.col("v")))
    assert got == [["http://x.com"], [], [], ["http://y.com"]]


def test_clean_link(spark):
    raw = [" http://a.com/\r\n", 'a"b', "\x1c　a\x00b ", "  ", "", 'a,b"', "\n\t x \n y", None]
    want = [
        None if r is None else r.strip().replace("\n", "").replace("\r", "").replace("\0", "").replace('"', "")
        for r in raw
    ]
    assert column(spark, raw, clean_link(F.col("v"))) == want
    made = ["".join(random.Random(i).choices(' \n"\x00x\u3000', k=i % 5)) for i in range(2000)]
    kept = [bool(m.strip().translate({10: None, 13: None, 0: None, 34: None})) for m in made]
    assert column(spark, made + [None], has_clean_text(F.col("v"))) == kept + [False]


@pytest.mark.parametrize("part", ["<b ", "<b x='", '<a href="x ', "<![CDATA[ x ", "<![if x ", "<!-- x ", "</b "])
def test_unfinished_tags_take_linear_time(spark, part):
    text = '<a href="http://a.com/p">x</a>' + part * (1_000_000 // len(part))
    start = time.time()
    assert column(spark, [text], page.anchor_links(F.col("v"))) == [["http://a.com/p"]]
    assert time.time() - start < 4


@pytest.mark.parametrize("part", ["<!-- x >", "<![CDATA[ x >", "<![if x >", "<b x='>", "<b >", "<a x >", "</b >", "<!-- <![if <![CDATA[ ]> "])
def test_tags_that_nothing_closes_take_linear_time(spark, part):
    text = '<a href="http://a.com/p">x</a>' + part * (1_000_000 // len(part)) + "'>" + '<a href="http://b.com/<!--q">y</a>'
    start = time.time()
    got = column(spark, [text], page.anchor_links(F.col("v")))
    assert got == [["http://a.com/p", "http://b.com/<!--q"]]
    assert time.time() - start < 6
