"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space between words.
SPACE = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def split_words(text: Column) -> Column:
    """Words between runs of white space; an empty array for blank text, null for null."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(split_words(text)).cast("bigint")


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def collapse_space(text: Column) -> Column:
    """Each run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def content_hash(data: Column) -> Column:
    """Hex SHA-256; an empty string for null."""
    return F.coalesce(F.sha2(data, 256), F.lit(""))


def document_id(url: Column, fetched_at: Column) -> Column:
    """First 16 hex digits of the SHA-256 of url, ``|`` and the time in ISO form with offset (UTC)."""
    utc = F.to_utc_timestamp(fetched_at, F.current_timezone())
    micros = F.date_format(utc, "SSSSSS")
    iso = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))
    return F.substring(F.sha2(F.concat_ws("|", url, iso), 256), 1, 16)


def site_key(url: Column) -> Column:
    """The authority of a URL (with port and user, if any) in lower case, without a leading ``www.``; empty if there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), r"^www\.", ""), F.lit(""))


def default_title(title: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(title), F.lit("")), F.lit("Untitled"))


def url_title(url: Column) -> Column:
    """The last path segment with ``-`` and ``_`` as blanks, in title case; null if the path is empty."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), "^/+|/+$", "")
    last = F.element_at(F.split(path, "/"), -1)
    return F.when(last != "", F.initcap(F.regexp_replace(last, "[-_]", " ")))


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base`` for absolute, scheme-less, rooted, query, fragment and plain relative links."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(F.coalesce(href, F.lit("")) == "", base)
        .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


def conditional_headers(etag: Column, last_modified: Column) -> Column:
    """The headers of a conditional request from what an earlier answer gave."""
    both = F.create_map(F.lit("If-None-Match"), etag, F.lit("If-Modified-Since"), last_modified)
    return F.map_filter(both, lambda k, v: v.isNotNull() & (v != ""))


def merge_defaults(values: Column, defaults: Column) -> Column:
    """A map with the entries of ``defaults`` for keys that ``values`` lacks."""
    return F.map_concat(F.map_filter(defaults, lambda k, v: ~F.map_contains_key(values, k)), values)


def repair_encoding(text: Column, passes: int = 2) -> Column:
    """UTF-8 that was read as Latin-1 or Windows-1252, decoded again up to ``passes`` times.

    All or nothing: text that isn't wholly made of one-byte characters, or whose bytes are no UTF-8, stays.
    """
    typographic = "".join(bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    controls = "".join(chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    out = text
    for _ in range(passes):
        low = F.translate(out, typographic, controls)
        fits = low.rlike(r"^[\x00-\xff]*$") & low.rlike(r"[\xc2-\xf4][\x80-\xbf]")
        again = F.try_validate_utf8(F.encode(F.when(fits, low), "ISO-8859-1").cast("string"))
        out = F.coalesce(again, out)
    return out
