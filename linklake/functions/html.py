"""Anchor extraction as column expressions.

One pattern runs over a page from left to right and stops at each anchor tag.
Comments, declarations, script and style bodies and every other tag are passed over
whole, so an anchor inside any of them is never seen. Loops over unbounded text are
either over one character class or possessive: Java runs both without recursion, the
first in a tight loop. What follows the last ">" is cut off first.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from linklake.functions.text import WHITESPACE, clean_link

# The schemes an anchor must start with to be kept.
LINK_PREFIXES = ("http://", "https://")

# White space for use inside a character class: single characters up to U+00FF,
# which Java tests with one table look-up, then the rest as short ranges.
_WS = "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE if c < "\u0100") + (
    r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
_NAME_END = r"[\t\n\r\f />\x00]"
_GAP = rf"(?:[{_WS}]|/(?!>))"
_VALUE = rf"""(?:'[^']*'|"[^"]*"|(?!['"])[^>{_WS}]*)"""
_VALUED = rf"(?:[{_WS}]*=+[{_WS}]*{_VALUE})?+"
_NAME = rf"""(?<=['"/{_WS}])[^{_WS}/>][^{_WS}/=>]*"""
_ATTRS = rf"(?:{_GAP}*+(?:{_NAME}{_VALUED}{_GAP}*+)*+)"


def _raw_text_element(name: str) -> str:
    """The element up to its end tag or, without one, to the end of the page."""
    end_tag = rf"</[{_WS}]*(?i:{name})[{_WS}]*>"
    return (
        rf"(?i:{name})(?={_NAME_END}){_ATTRS}[{_WS}]*>"
        rf"(?:[^<]+|(?!{end_tag})<)*+(?:{end_tag}|\z)"
    )


_ANCHOR = rf"[aA](?={_NAME_END}){_ATTRS}[{_WS}]*/?>"
_OTHER_MARKUP = "|".join(
    [
        rf"!--(?:[^-]+|-(?!-[{_WS}]*>))*+--[{_WS}]*>",
        rf"!\[(?i:temp|cdata|ignore|include|rcdata)(?![-_.a-zA-Z0-9])[\s\S]*?\][{_WS}]*\][{_WS}]*>",
        rf"!\[(?i:if|else|endif)(?![-_.a-zA-Z0-9])[\s\S]*?\][{_WS}]*>",
        r"[!?/][^>]*>",
        _raw_text_element("script"),
        _raw_text_element("style"),
        rf"[a-zA-Z][^\t\n\r\f />\x00]*{_ATTRS}[{_WS}]*/?>",
        r"[a-zA-Z][^>]*>",
    ]
)
# The bulk of all tags, told by their first characters: end tags, and start tags
# without attributes whose name starts neither like an anchor nor a script or style.
_COMMON_TAG = r"/[^>]*>|[b-rt-zB-RT-Z][a-zA-Z0-9]*>"
# From the end of the last match over all text and other markup to the next anchor
# tag, whose attributes are captured, or to the end of the page.
_NEXT_ANCHOR = (
    rf"\G(?:[^<]+|<(?:{_COMMON_TAG}|(?!{_ANCHOR})(?:{_OTHER_MARKUP}|)))*+"
    rf"(?:<[aA](?={_NAME_END})({_ATTRS})[{_WS}]*/?>|\z)"
)
_ATTR = rf"""(?:((?<=['"/{_WS}])[hH][rR][eE][fF](?![^{_WS}/=>]){_VALUED})|{_NAME}{_VALUED})"""
_HREF_VALUE = rf"(?s)\A.{{4}}[{_WS}]*=+[{_WS}]*({_VALUE})\z"

_REFERENCE = r"\A(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@cache
def _entity_json() -> str:
    return json.dumps(html5, ensure_ascii=True, sort_keys=True)


@cache
def _unterminated_names() -> str:
    """Names that are known without ``;``, longest first."""
    names = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return r"\A(" + "|".join(names) + ")"


def _code_point_text(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numeric_reference(digits: Column, base: int) -> Column:
    significant = F.ltrim(digits, F.lit("0"))
    code = F.when(
        F.length(significant) <= 7,
        F.conv(F.concat(F.lit("0"), significant), base, 10).cast("bigint"),
    ).otherwise(F.lit(0x110000).cast("bigint"))
    # The C1 range is read as Windows-1252, as browsers do.
    c1 = "".join(
        bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xA0)
    )
    dropped = (
        code.between(0x1, 0x8)
        | code.between(0xE, 0x1F)
        | (code == 0xB)
        | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF)
        | code.bitwiseAND(0xFFFE).eqNullSafe(0xFFFE)
    )
    return (
        F.when(
            (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd")
        )
        .when(
            code.between(0x80, 0x9F),
            F.substring(F.lit(c1), (code - 0x7F).cast("int"), F.lit(1)),
        )
        .when(dropped, F.lit(""))
        .otherwise(_code_point_text(code))
    )


def _named_reference(name: Column) -> Column:
    known = F.element_at(F.from_json(F.lit(_entity_json()), "map<string,string>"), name)
    shorter = F.regexp_extract(name, _unterminated_names(), 1)
    short_text = F.element_at(F.from_json(F.lit(_entity_json()), "map<string,string>"), shorter)
    return (
        F.when(name.isin("amp;", "amp"), F.lit("&"))
        .when(known.isNotNull(), known)
        .when(
            F.length(shorter) > 0,
            F.concat(short_text, F.substring(name, F.length(shorter) + 1, F.length(name))),
        )
        .otherwise(F.concat(F.lit("&"), name))
    )


def _resolve(piece: Column) -> Column:
    """Text for a piece that followed an ampersand: ``ref`` and ``rest``."""
    ref, rest = piece["ref"], piece["rest"]
    body = F.rtrim(ref, F.lit(";"))
    resolved = (
        F.when(ref == "", F.lit("&"))
        .when(ref.rlike(r"\A#[xX]"), _numeric_reference(F.substring(body, F.lit(3), F.length(body)), 16))
        .when(ref.startswith("#"), _numeric_reference(F.substring(body, F.lit(2), F.length(body)), 10))
        .otherwise(_named_reference(ref))
    )
    return F.concat(resolved, rest)


def _cut_reference(piece: Column) -> Column:
    ref = F.regexp_extract(piece, _REFERENCE, 1)
    return F.struct(ref.alias("ref"), F.substring(piece, F.length(ref) + 1, F.length(piece)).alias("rest"))


def unescape(text: Column) -> Column:
    """Resolve HTML character references, named and numeric."""
    pieces = F.split(text, "&", -1)
    later = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _cut_reference)
    decoded = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(later, _resolve), ""))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def is_absolute_link(href: Column) -> Column:
    """True for a value that starts with, and is more than, an http(s) scheme."""
    starts = F.startswith(href, F.lit(LINK_PREFIXES[0])) | F.startswith(href, F.lit(LINK_PREFIXES[1]))
    return starts & ~href.isin(*LINK_PREFIXES)


def _last_href(attributes: Column) -> Column:
    """The last ``href`` attribute of a tag, as written; null if it has none."""
    hrefs = F.regexp_extract_all(attributes, F.lit(_ATTR), F.lit(1))
    return F.try_element_at(F.filter(hrefs, lambda attribute: attribute != ""), F.lit(-1))


def _unquoted(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


# Openers that ask for a closing mark further on, and that mark.
_CLOSERS = (
    (r"<!(?=--)", "<!--", rf"--[{_WS}]*>"),
    (r"<!(?=\[(?i:temp|cdata|ignore|include|rcdata)(?![-_.a-zA-Z0-9]))", "<![", rf"\][{_WS}]*\][{_WS}]*>"),
    (r"<!(?=\[(?i:if|else|endif)(?![-_.a-zA-Z0-9]))", "<![", rf"\][{_WS}]*>"),
)
_UNCLOSED = "<!\ufffe"  # a noncharacter, which no page holds


def _measured(page: Column, start: str, closer: str) -> Column:
    """The page, and how much to leave alone: up to the last closing mark, or all of it if
    there is no opener."""
    head = F.length(F.regexp_extract(page, rf"(?s)\A.*{closer}", 0))
    size = F.when(F.contains(page, F.lit(start)), head).otherwise(F.length(page))
    return F.struct(page.alias("page"), size.alias("size"))


def _marked_after(found: Column, opener: str) -> Column:
    page, size = found["page"], found["size"]
    tail = F.regexp_replace(F.substring(page, size + 1, F.length(page)), opener, _UNCLOSED)
    return F.concat(F.substring(page, F.lit(1), size), tail)


def _marked(html: Column) -> Column:
    """The page with a mark in each opener that nothing closes any more.

    The pattern then takes it for a plain declaration at once. It would come to the same
    after a search to the end of the page, from each of them.
    """
    pages = F.array(html)
    for opener, start, closer in _CLOSERS:
        found = F.transform(pages, lambda page: _measured(page, start, closer))  # noqa: B023
        pages = F.transform(found, lambda page: _marked_after(page, opener))  # noqa: B023
    return F.element_at(pages, 1)


def anchor_hrefs(html: Column) -> Column:
    """All ``<a href>`` values of a page in page order, relative ones included.

    One small step after another over the array: what a step works out for an
    element is bound to the next one's variable and never worked out twice.
    """
    # No tag ends after the last ">". Without that tail a page of unfinished tags has
    # nothing the pattern could search to the end for, again and again.
    tail = F.instr(F.reverse(html), ">")
    closed = F.when(tail > 0, F.substring(html, F.lit(1), F.length(html) - tail + 1)).otherwise("")
    found = F.transform(F.array(_marked(closed)), lambda page: F.regexp_extract_all(page, F.lit(_NEXT_ANCHOR), F.lit(1)))
    attributes = F.filter(F.element_at(found, 1), lambda found: found != "")
    attributes = F.transform(attributes, lambda found: F.replace(found, F.lit(_UNCLOSED), F.lit("<!")))
    written = F.filter(F.transform(attributes, _last_href), lambda href: href.isNotNull())
    values = F.transform(written, lambda href: F.regexp_extract(href, _HREF_VALUE, 1))
    return F.transform(F.transform(values, _unquoted), unescape)


def anchor_links(html: Column) -> Column:
    """Cleaned absolute anchors of a page, in page order, repeats kept."""
    links = F.transform(F.filter(anchor_hrefs(html), is_absolute_link), clean_link)
    return F.filter(links, lambda link: F.length(link) > 0)
