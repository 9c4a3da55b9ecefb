"""URL expressions with the leniency of a generic RFC 3986 split.

Everything here is a native column expression, so it stays inside whole-stage
code generation. ``parse_url`` is not used: under ANSI it raises on links that
hold blanks or bars, and it keeps path parameters.

A link is cut up once, by one pattern, into site and path (``split_link``); the
rest are cheap string functions over that. Jobs that need both keep the cut text
in a column of its own, as ``operators.sites`` does: Spark then cuts once a row.
"""

from __future__ import annotations

from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes whose last path segment may carry ``;params``.
PARAM_SCHEMES = [
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
    "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
]
# Schemes written with ``//`` even when the authority is empty.
AUTHORITY_SCHEMES = [
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
    "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync",
    "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
]
# Characters that NFKC folds into one of / ? # @ : (or into a text
# holding one), which makes an authority invalid.
NFKC_RESERVED = (
    "\u2047\u2048\u2049\u2100\u2101\u2105\u2106\u2a74\ufe13\ufe16"
    "\ufe55\ufe56\ufe5f\ufe6b\uff03\uff0f\uff1a\uff1f\uff20"
)
# Generic suffixes counted as US.
US_SUFFIXES = ["com", "org", "net"]
# Full stops of other scripts that separate host labels.
_DOTS = "\u3002\uff0e\uff61"


_SCHEME = r"(?:([A-Za-z][A-Za-z0-9+.\-]*):)?+"
_AUTHORITY_AND_PATH = r"(?://([^/?#]*+))?+([^?#]*+)"
_SITE_AND_PATH = rf"(?s)\A{_SCHEME}{_AUTHORITY_AND_PATH}.*+\z"
_FIVE_PARTS = rf"(?s)\A{_SCHEME}{_AUTHORITY_AND_PATH}(?:\?([^#]*+))?+(?:#(.*+))?+\z"
# A link with nothing to strip and an authority with nothing to check. Letters are
# spelled out because Java tests such a class with one table look-up.
_PLAIN = (
    rf"\Ahttps?://[{ascii_letters}{digits}.:_\-]++(?:[/?#][^\t\r\n]*+)?\z"
)
_LEADING = "".join(map(chr, range(0x21)))


def _ipv6_pattern() -> str:
    """The RFC 3986 IPv6address rule, with an optional zone."""
    h16 = "[0-9A-Fa-f]{1,4}"
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    ls32 = rf"(?:{h16}:{h16}|{octet}(?:\.{octet}){{3}})"
    forms = [f"(?:{h16}:){{6}}{ls32}"]
    for before in range(8):
        head = f"(?:(?:{h16}:){{0,{before - 1}}}{h16})?" if before else ""
        groups = 5 - before
        tail = f"(?:{h16}:){{{groups}}}{ls32}" if groups >= 0 else (h16 if groups == -1 else "")
        forms.append(f"{head}::{tail}")
    return rf"(?:{'|'.join(forms)})(?:%[^%\]/?#]+)?"


def _valid_pattern() -> str:
    """No authority, one without brackets, or one whose first bracket opens an IP
    literal. The last form has its closing bracket before the opening one."""
    inside = rf"(?:{_ipv6_pattern()}|v[a-fA-F0-9]+\.[^\]/?#]+)"
    end = r"(?=[/?#]|\z)"
    odd = NFKC_RESERVED
    authority = "|".join(
        [
            rf"[^/?#\[\]{odd}]*+{end}",
            rf"[^/?#\[{odd}]*+\[{inside}\][^/?#{odd}]*+{end}",
            rf"(?=[^/?#\[]*\])[^/?#\[{odd}]*+\[{inside}{end}",
        ]
    )
    return rf"\A{_SCHEME}(?:(?!//)|//(?:{authority}))"


def _prepared(link: Column) -> Column:
    return F.regexp_replace(F.ltrim(link, F.lit(_LEADING)), r"[\t\r\n]+", "")


def split_link(link: Column) -> Column:
    """A link as ``scheme://netloc`` and path, one a line.

    Line breaks cannot be part of either: they are dropped from the link. Scheme
    or authority are empty where the link has none.
    """
    return F.regexp_replace(_prepared(link), _SITE_AND_PATH, "$1://$2\n$3")


def site_of(parts: Column) -> Column:
    """``scheme://netloc``: scheme in lower case, authority as written."""
    site = F.substring_index(parts, "\n", 1)
    scheme = F.substring_index(site, "://", 1)
    lowered = F.concat(F.lower(scheme), F.substring(site, F.length(scheme) + 1, F.length(site)))
    usual = F.startswith(site, F.lit("http://")) | F.startswith(site, F.lit("https://"))
    return F.when(usual, site).otherwise(lowered)


def path_of(parts: Column) -> Column:
    """Path without the ``;params`` of its last segment."""
    path = F.substring_index(parts, "\n", -1)
    scheme = F.lower(F.substring_index(parts, "://", 1))
    return F.when(
        F.contains(path, F.lit(";")) & scheme.isin(PARAM_SCHEMES),
        F.regexp_replace(path, r";[^/]*+\z", ""),
    ).otherwise(path)


def is_root(path: Column) -> Column:
    return path.isin("", "/")


def url_path(link: Column) -> Column:
    """Path without query, fragment and the ``;params`` of its last segment."""
    return path_of(split_link(link))


def is_plain_url(link: Column) -> Column:
    """True for the common kind of link that needs no further check."""
    return link.rlike(_PLAIN)


def is_valid_odd_url(link: Column) -> Column:
    """``is_valid_url`` for links that are not plain, which need the full check."""
    return _prepared(link).rlike(_valid_pattern())


def is_valid_url(link: Column) -> Column:
    """False for unbalanced or non-IP brackets and for authorities that NFKC
    would turn into something with a reserved character."""
    return is_plain_url(link) | is_valid_odd_url(link)


def primary_link(link: Column) -> Column:
    """``scheme://netloc`` of a link; null for an invalid URL."""
    return F.when(is_valid_url(link), site_of(split_link(link)))


def is_homepage(link: Column) -> Column:
    """True when the path is empty or ``/``; false for an invalid URL."""
    return is_valid_url(link) & is_root(url_path(link))


def subsection(link: Column) -> Column:
    """Path of a link that is not a home page; null otherwise."""
    path = url_path(link)
    return F.when(is_valid_url(link) & ~is_root(path), path)


def quote_path(path: Column) -> Column:
    """Percent-encode a path, keeping ``/`` and the unreserved characters."""
    encoded = F.url_encode(path)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def encode_url_path(link: Column) -> Column:
    """The URL with only its path percent-encoded; null for an invalid URL.

    Empty query, fragment and parameter marks are dropped by the rebuild.
    """
    parts = F.split(
        F.regexp_replace(_prepared(link), _FIVE_PARTS, "$1\n$2\n$3\n$4\n$5"), "\n", -1
    )
    scheme, netloc, whole_path, query, fragment = (F.get(parts, i) for i in range(5))
    scheme = F.lower(scheme)
    has_params = scheme.isin(PARAM_SCHEMES) & F.contains(whole_path, F.lit(";"))
    bare_path = F.when(has_params, F.regexp_replace(whole_path, r";[^/]*+\z", "")).otherwise(whole_path)
    params = F.when(has_params, F.regexp_extract(whole_path, r";([^/]*+)\z", 1)).otherwise(F.lit(""))

    def marked(mark: str, text: Column) -> Column:
        return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(mark), text))

    path = F.concat(quote_path(bare_path), marked(";", params))
    rooted = F.when((path == "") | path.startswith("/"), path).otherwise(
        F.concat(F.lit("/"), path)
    )
    located = (
        F.when(netloc != "", F.concat(F.lit("//"), netloc, rooted))
        .when(path.startswith("//"), F.concat(F.lit("//"), path))
        .when(
            (scheme != "")
            & scheme.isin(AUTHORITY_SCHEMES)
            & ((path == "") | path.startswith("/")),
            F.concat(F.lit("//"), path),
        )
        .otherwise(path)
    )
    prefix = F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit(":")))
    return F.when(
        is_valid_url(link),
        F.concat(prefix, located, marked("?", query), marked("#", fragment)),
    )


def site_host(site: Column) -> Column:
    """Lower-case host of a ``scheme://netloc``: user, port and trailing dots
    dropped; ``''`` if there is none. IP literals keep their brackets."""
    located = F.substring_index(F.substring_index(site, "/", -1), "@", -1)
    bare = F.when(
        F.startswith(located, F.lit("[")), F.concat(F.substring_index(located, "]", 1), F.lit("]"))
    ).otherwise(F.substring_index(located, ":", 1))
    return F.lower(F.rtrim(F.trim(F.translate(bare, _DOTS, "...")), F.lit(".")))


def host(link: Column) -> Column:
    """Lower-case host of a link; null for an invalid URL."""
    return site_host(primary_link(link))


def is_ip_host(host_name: Column) -> Column:
    return host_name.rlike(r"\A(?:\[.*|[0-9]{1,3}(?:\.[0-9]{1,3}){3})\z")


def fqdn(host_name: Column) -> Column:
    """The host when it is a dotted name; null for addresses and bare labels."""
    return F.when(F.contains(host_name, F.lit(".")) & ~is_ip_host(host_name), host_name)


def last_label(host_name: Column) -> Column:
    return F.substring_index(F.lower(host_name), ".", -1)


def dotted(label: Column) -> Column:
    """A label lower-cased and led by a dot, as the country table spells it."""
    lowered = F.lower(label)
    return F.when(lowered.startswith("."), lowered).otherwise(F.concat(F.lit("."), lowered))
