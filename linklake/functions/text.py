"""String, header and payload expressions (all JVM-side except declared charsets)."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Ship this module's Arrow function with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The code points a Python ``str`` treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: what is taken out of a link wherever it stands.
LINK_DIRT = '\n\r\x00"'


def clean_link(link: Column) -> Column:
    """Strip white space, then drop line breaks, NULs and double quotes.

    Quoting of links that hold a comma belongs to the link file and is done by
    ``sinks.links.link_line``.
    """
    return F.regexp_replace(F.trim(link, F.lit(WHITESPACE)), f"[{LINK_DIRT}]+", "")


def has_clean_text(link: Column) -> Column:
    """True if something is left of a link once it is cleaned.

    Told from the raw link, mostly by its first character: a filter on the cleaned
    link would be pushed below the cleaning and have it done twice.
    """
    return link.isNotNull() & ~link.rlike(rf"\A[{WHITESPACE}]*[{LINK_DIRT}]*[{WHITESPACE}]*\z")


def is_nonempty(link: Column) -> Column:
    """True for a link that is neither null nor empty."""
    return F.coalesce(F.length(link) > 0, F.lit(False))


def header(headers: Column, name: str, default: str | None = "") -> Column:
    """Value of a header (map keys are lower case), or ``default``."""
    value = F.element_at(headers, F.lit(name.lower()))
    return value if default is None else F.coalesce(value, F.lit(default))


def decode_utf8(payload: Column) -> Column:
    """UTF-8 text of a payload; malformed bytes become U+FFFD."""
    return F.make_valid_utf8(payload.cast("string"))


@F.pandas_udf(StringType())
def _decode_declared(payload: pd.Series, charset: pd.Series) -> pd.Series:
    import codecs

    def text(raw, name):
        if raw is None:
            return None
        try:
            codec = codecs.lookup(name).name if name else "utf-8"
            return bytes(raw).decode(codec, errors="replace")
        except (LookupError, ValueError):
            return bytes(raw).decode("utf-8", errors="replace")

    return pd.Series([text(p, c) for p, c in zip(payload, charset)], dtype="object")


# Names of the charsets that are decoded without Python.
UTF8_NAMES = ("utf-8", "utf8", "u8", "cp65001")
LATIN1_NAMES = ("iso-8859-1", "iso8859-1", "latin-1", "latin1", "l1", "8859", "cp819", "iso-ir-100")
ASCII_NAMES = ("us-ascii", "ascii", "646", "ansi-x3.4-1968", "iso646-us")


def decode_with_charset(payload: Column, charset: Column) -> Column:
    """Text of a payload in its declared charset; UTF-8 where none is declared or known.

    UTF-8, ISO-8859-1 and US-ASCII, nearly all of the web, are decoded by native
    expressions; malformed bytes become U+FFFD. Only payloads in other charsets are handed to
    Python: for all other rows it gets a null.
    """
    name = F.regexp_replace(F.lower(F.trim(charset)), "[_ ]", "-")
    is_utf8 = charset.isNull() | (charset == "") | name.isin(*UTF8_NAMES)
    latin1 = F.decode(payload, "ISO-8859-1")
    is_native = is_utf8 | name.isin(*LATIN1_NAMES, *ASCII_NAMES)
    return (
        F.when(is_utf8, decode_utf8(payload))
        .when(name.isin(*LATIN1_NAMES), latin1)
        .when(name.isin(*ASCII_NAMES), F.regexp_replace(latin1, r"[^\x00-\x7f]", "\ufffd"))
        .otherwise(_decode_declared(F.when(~is_native, payload), F.when(~is_native, charset)))
    )
