"""Dates, reference numbers and types of regulatory documents, by jurisdiction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD_CHARS = 3000

# Per jurisdiction the date shapes with their formats, the reference shapes and the type keywords, each in order.
DATES = {
    "RBI": ((r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})", "d MMM yyyy"), (r"(\d{2}/\d{2}/\d{4})", "dd/MM/yyyy"), (r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd")),
    "SEBI": ((r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})", "d MMM yyyy"), (r"(\d{2}/\d{2}/\d{4})", "MM/dd/yyyy"), (r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd")),
    "FDA": ((r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})", "d MMM yyyy"), (r"(\d{2}/\d{2}/\d{4})", "MM/dd/yyyy"), (r"([A-Za-z]+\s+\d{1,2},\s+\d{4})", "MMMM d, yyyy")),
    "EU_AI_ACT": ((r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"), (r"(\d{1,2}\s+[A-Za-z]+\s+\d{4})", "d MMMM yyyy")),
}
REFERENCES = {
    "RBI": (r"(RBI/\d{4}-\d{2}/[A-Z]+/\d+)", r"(DBR\.\w+\.No\.\d+/\d+\.\d+\.\d+/\d{4}-\d{2})", r"(RBI/[A-Z]+/\d{4}-\d{2}/\d+)", r"(\b[A-Z]{2,4}\.\w+\.No\.\d+/\d{4}-\d{2})"),
    "SEBI": (r"(SEBI/HO/\w+/\d+/CIR/\d{4}/\d+)", r"(SEBI/LAD-NRO/GN/\d{4}/\d+)", r"(SEBI/CIR/\w+/\d+)"),
    "FDA": (r"(\d+\s+FR\s+\d{5})", r"(FR\s+Doc\.\s+\d{4}-\d{5})", r"(RIN\s+\d{4}-\w{2,4})", r"(Docket\s+No\.\s+[A-Z0-9\-]+)"),
    "EU_AI_ACT": (r"(?i)(Article\s+\d+[A-Z]?)", r"(?i)(Annex\s+[IVXLC]+)", r"(?i)(Recital\s+\d+)", r"(?i)(Chapter\s+[IVXLC]+)"),
}
URL_REFERENCES = (
    r"(?i)(RBI/\d{4}-\d{2}/[A-Z]+/\d+)",
    r"(?i)(SEBI/HO/\w+/\d+/CIR/\d{4}/\d+)",
    r"(?i)(Article\s+\d+[A-Z]?)",
    r"(?i)(Annex\s+[IVXLC]+)",
    r"(?i)(Recital\s+\d+)",
    r"(?i)(\d+\s+FR\s+\d+)",
    r"(?i)(FR\s+Doc\.\s+\d{4}-\d{5})",
    r"(?i)(RIN\s+\d{4}-\w{2,4})",
)
TYPES = {
    "RBI": (("NOTIFICATION", "notification|circular|direction|master direction|master circular"), ("PRESS_RELEASE", "press release|pressrelease|press statement")),
    "SEBI": (("CIRCULAR", "circular|guidelines|directions"),),
    "FDA": (("REGULATION", "federal register|final rule|proposed rule|notice of proposed rulemaking|fr doc"), ("RSS_ITEM", "press release|press announcement|safety communication|drug safety|recall")),
    "EU_AI_ACT": (("REGULATION", "article|annex|recital|chapter|regulation|directive"), ("NEWS", "news|press release|statement|speech")),
}
FALLBACK_TYPES = {"RBI": None, "SEBI": "CIRCULAR", "FDA": "RSS_ITEM", "EU_AI_ACT": "NEWS"}
LISTING_REFERENCES = {
    "rbi": r"\b([A-Z]{2,}\.\w+(?:\.\w+)*/\d+(?:\.\d+)*(?:/\d{2,4}(?:-\d{2,4})?)?)\b",
    "sebi": r"\b(SEBI/[A-Z0-9./-]+(?:/\d{4}/\d+)?)\b",
    "fda": r"\b(FDA-\d{4}-\d+)\b",
    "eu_ai_act": r"(?i)\b(Article\s+\d+[A-Z]?|Annex\s+[IVX]+|Recital\s+\d+)\b",
}
LISTING_DATES = (
    (r"\b(\d{1,2}\s+[A-Za-z]+\s+\d{4})\b", "d MMMM yyyy"),
    (r"\b([A-Za-z]+\s+\d{1,2},?\s+\d{4})\b", "MMMM d yyyy"),
    (r"\b(\d{2}/\d{2}/\d{4})\b", "dd/MM/yyyy"),
    (r"\b(\d{4}-\d{2}-\d{2})\b", "yyyy-MM-dd"),
)


def head(text: Column) -> Column:
    """The part of a text in which metadata is looked for."""
    return F.substring(text, 1, HEAD_CHARS)


def _tidy_date(value: Column) -> Column:
    """White space collapsed and the month capitalised, as the parser wants it."""
    return F.initcap(F.regexp_replace(value, r"\s+", " "))


def first_date(text: Column, pattern: str, form: str) -> Column:
    """The first match of a shape that is a date of the calendar; null if none is."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: F.try_to_timestamp(_tidy_date(x), F.lit(form)))
    return F.try_element_at(F.array_compact(found), F.lit(1))


def by_jurisdiction(jurisdiction: Column, make) -> Column:
    """``make(name)`` for the row's jurisdiction; null for any other."""
    out = F.when(F.lit(False), F.lit(None))
    for name in DATES:
        out = out.when(jurisdiction == name, make(name))
    return out


def published_date(text: Column, jurisdiction: Column) -> Column:
    """The first shape of the jurisdiction of which any match is a date."""
    return by_jurisdiction(jurisdiction, lambda j: F.coalesce(*(first_date(head(text), p, f) for p, f in DATES[j])))


def _first(text: Column, patterns) -> Column:
    return F.coalesce(*(F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns))


def reference_number(text: Column, url: Column, jurisdiction: Column) -> Column:
    """The jurisdiction's reference number in the text, else any known kind in the URL."""
    return F.coalesce(by_jurisdiction(jurisdiction, lambda j: _first(head(text), REFERENCES[j])), _first(url, URL_REFERENCES))


def document_type(text: Column, url: Column, jurisdiction: Column) -> Column:
    """The first type with a keyword in text or URL, else the jurisdiction's default."""
    both = F.lower(F.concat_ws(" ", head(text), url))

    def make(name: str) -> Column:
        out = F.lit(FALLBACK_TYPES[name]).cast("string")
        return reduce(lambda rest, x: F.when(both.rlike(x[1]), x[0]).otherwise(rest), reversed(TYPES[name]), out)

    return by_jurisdiction(jurisdiction, make)


def listing_date(text: Column) -> Column:
    """The date in a listing's cell: the first match of each shape, in order."""
    return F.coalesce(*(F.try_to_timestamp(F.regexp_replace(_tidy_date(F.regexp_extract(text, p, 1)), ",", ""), F.lit(f)) for p, f in LISTING_DATES))


def listing_reference(text: Column, adapter: str) -> Column:
    return F.nullif(F.regexp_extract(text, LISTING_REFERENCES[adapter], 1), F.lit(""))


def feed_date(*values: Column) -> Column:
    """The first readable one of a feed item's dates (RFC 822 or ISO), as a UTC timestamp."""

    def one(v: Column) -> Column:
        bare = F.regexp_replace(F.trim(v), r"^\w{3},\s*", "")
        zoned = F.regexp_replace(bare, r"\s*(GMT|UTC|Z)$", " +0000")
        return F.coalesce(F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(F.trim(v), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp(F.trim(v), F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp(F.trim(v), F.lit("yyyy-MM-dd")))

    return F.coalesce(*map(one, values))
