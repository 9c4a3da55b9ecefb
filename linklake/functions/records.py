"""Predicates over the record table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linklake.functions.text import header

# Media types counted as HTML.
HTML_TYPES = ["text/html", "application/xhtml+xml"]


def is_response(rec_type: Column) -> Column:
    return F.coalesce(rec_type == "response", F.lit(False))


def is_extracted_text(rec_type: Column, content_type: Column) -> Column:
    """Plain-text conversion records."""
    return F.coalesce((rec_type == "conversion") & (content_type == "text/plain"), F.lit(False))


def is_json_metadata(rec_type: Column, content_type: Column) -> Column:
    """JSON metadata records."""
    return F.coalesce(
        (rec_type == "metadata") & (content_type == "application/json"), F.lit(False)
    )


def declares_html(http_headers: Column) -> Column:
    """The HTTP content type names text/html, in any case. A record without an
    HTTP header block is not HTML."""
    return F.coalesce(
        F.contains(F.lower(header(http_headers, "content-type")), F.lit("text/html")), F.lit(False)
    )


def is_html(warc_headers: Column, http_headers: Column) -> Column:
    """The detected payload type is HTML or the HTTP content type, as written,
    names an HTML type."""
    detected = header(warc_headers, "warc-identified-payload-type").isin(HTML_TYPES)
    declared = header(http_headers, "content-type")
    named = F.contains(declared, F.lit(HTML_TYPES[0])) | F.contains(declared, F.lit(HTML_TYPES[1]))
    return F.coalesce(detected, F.lit(False)) | F.coalesce(named, F.lit(False))
