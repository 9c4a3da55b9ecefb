import random

from conftest import column
from pyspark.sql import functions as F

from linklake.functions import records, text


def test_whitespace_is_what_python_strips():
    assert text.WHITESPACE == "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def test_decode_utf8_replaces_like_python(spark):
    rnd = random.Random(2)
    raws = [b"caf\xc3\xa9", b"\xff\xfe", b"a\xe2\x82", b"\xed\xa0\x80", b"\xf0\x9f\x98\x80", b""]
    raws += [bytes(rnd.choices(range(0x60, 0x100), k=12)) for _ in range(500)]
    got = column(spark, raws, text.decode_utf8(F.col("v")), "binary")
    assert got == [r.decode("utf-8", errors="replace") for r in raws]


def test_decode_with_charset(spark):
    rows = [("café".encode("latin-1"), "ISO-8859-1"), ("日本".encode("shift_jis"), "Shift_JIS"),
            (b"\xc3\xa9\xff", None), (b"\xc3\xa9", "no-such-charset"), (None, "utf-8")]
    frame = spark.createDataFrame(rows, "p binary, c string")
    got = [r[0] for r in frame.select(text.decode_with_charset(F.col("p"), F.col("c"))).collect()]
    assert got == ["café", "日本", "é�", "é", None]


def test_header_lookup(spark):
    frame = spark.createDataFrame([({"content-type": "a"},), (None,)], "h map<string,string>")
    got = frame.select(
        text.header(F.col("h"), "Content-Type"), text.header(F.col("h"), "x"), text.header(F.col("h"), "x", None)
    ).collect()
    assert [tuple(r) for r in got] == [("a", "", None), ("", "", None)]


def test_record_predicates(spark):
    rows = [
        ("response", "application/http", {}, {"content-type": "TEXT/HTML"}),
        ("response", "application/http", {"warc-identified-payload-type": "application/xhtml+xml"}, None),
        ("conversion", "text/plain", {}, None),
        ("metadata", "application/json", {}, {"content-type": "application/xhtml+xml; x"}),
        (None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "t string, c string, w map<string,string>, h map<string,string>")
    kind, content = F.col("t"), F.col("c")
    got = frame.select(
        records.is_response(kind), records.is_extracted_text(kind, content), records.is_json_metadata(kind, content),
        records.declares_html(F.col("h")), records.is_html(F.col("w"), F.col("h")),
    ).collect()
    assert [tuple(map(int, r)) for r in got] == [
        (1, 0, 0, 1, 0), (1, 0, 0, 0, 1), (0, 1, 0, 0, 0), (0, 0, 1, 0, 1), (0, 0, 0, 0, 0)
    ]
