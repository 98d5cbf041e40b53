"""Listing pages and feeds turned into entries, one reader for each adapter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions import html, metadata
from docforge.functions.text import absolute_url
from docforge.schemas import ENTRY_METADATA

#: (href, title, date text, summary, department, reference) of an entry as it stands in the page.
Found = tuple[str, str, str, str, str, str]
READERS: dict[str, Callable[[html.Node], list[Found]]] = {}
# The type of a source's entries.
ENTRY_TYPES = {"rbi_notifications": "NOTIFICATION", "rbi_press": "PRESS_RELEASE", "sebi": "CIRCULAR", "eu_ai_act": "NEWS", "fda_rss": "PRESS_RELEASE"}


def reader(name: str):
    """Register a function as the reader of listings of kind ``name``."""

    def add(f: Callable[[html.Node], list[Found]]):
        READERS[name.lower()] = f
        return f

    return add


def find_reader(name: str) -> Callable[[html.Node], list[Found]]:
    try:
        return READERS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown adapter {name!r}; known: {', '.join(sorted(READERS))}") from None


def _text(node: html.Node | None) -> str:
    return "".join(x.strip() for x in node.strings()) if node is not None else ""


def _link(node: html.Node | None) -> str | None:
    if node is None:
        return None
    a = node if node.tag == "a" else next((n for n in html.find_all(node, "a") if "href" in n.attrs), None)
    return a.attrs.get("href") if a is not None else None


def _row(node: html.Node) -> list[html.Node]:
    return html.find_all(node, "td")


def _cards(node: html.Node, dates: tuple[str, ...], titles: tuple[str, ...]) -> Found | None:
    title = html.find(node, *titles)
    href = _link(title)
    return (href, _text(title), _text(html.find(node, *dates)), "", "", "") if href else None


@reader("rbi_notifications")
def _notifications(page: html.Node) -> list[Found]:
    """Rows of date, subject with link, department and number."""
    out = []
    for table in html.find_all(page, "table"):
        for tr in html.find_all(table, "tr"):
            cells = _row(tr)
            href = _link(cells[1]) if len(cells) >= 3 else None
            if href:
                out.append((href, _text(cells[1]), _text(cells[0]), "", _text(cells[2]), _text(cells[3]) if len(cells) > 3 else ""))
    return out


@reader("rbi_press")
def _press(page: html.Node) -> list[Found]:
    """Rows of date and linked title, or cards."""
    out = []
    for item in html.find_all(page, ".press-release", ".pr-item", "tr", ".content-block"):
        if item.tag == "tr":
            cells = _row(item)
            hit = (_link(cells[1]), _text(cells[1]), _text(cells[0]), "", "", "") if len(cells) >= 2 else None
        else:
            hit = _cards(item, (".date", ".pr-date", "time"), (".title", ".pr-title", "h3", "h4", "a"))
        if hit and hit[0]:
            out.append(hit)
    return out


@reader("sebi")
def _circulars(page: html.Node) -> list[Found]:
    out = []
    for item in html.find_all(page, "tr", ".circular-item", ".legal-circular"):
        if item.tag == "tr":
            cells = _row(item)
            hit = (_link(cells[1]), _text(cells[1]), _text(cells[0]), "", "", "") if len(cells) >= 2 else None
        else:
            hit = _cards(item, (".date", ".circular-date", "time"), (".title", ".circular-title", "h3", "h4", "a"))
        if hit and hit[0]:
            out.append(hit)
    return out


@reader("eu_ai_act")
def _news(page: html.Node) -> list[Found]:
    out = []
    for item in html.find_all(page, "article", ".post", ".news-item", ".entry"):
        a = next((n for n in html.find_all(item, "a") if n.attrs.get("href")), None)
        if a is not None:
            out.append((a.attrs["href"], _text(a), _text(html.find(item, "time", ".date", ".post-date", ".published")), _text(html.find(item, ".excerpt", ".summary", ".description", "p")), "", ""))
    return out


def entries_from_pages(pages: DataFrame, base_url: str, kind_col: str = "kind", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Entries of listing pages: url, title, published_date, summary, metadata, position, and the columns in ``keep``.

    ``kind_col`` names the reader. Null and unreadable pages have no entries.
    """
    names = sorted(READERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for i, (kind, text) in enumerate(zip(b.column(kind_col).to_pylist(), b.column(html_col).to_pylist())):
                if text and kind in names:
                    found = READERS[kind](html.tree(text))
                    at += [i] * len(found)
                    rows += [(p, *x) for p, x in enumerate(found)]
            cols = list(zip(*rows)) or [[]] * 7
            idx = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(idx) for c in (*keep, kind_col)), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.string()) for c in cols[1:])], [*keep, "kind", "position", "href", "title", "date_text", "summary", "department", "reference"])

    kept = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)
    x = pages.select(*keep, kind_col, html_col).mapInArrow(run, f"{kept}kind string, position int, href string, title string, date_text string, summary string, department string, reference string")
    found = lambda c: F.coalesce(*(F.when(F.col("kind") == k, metadata.listing_reference(c, a)) for k, a in (("rbi_notifications", "rbi"), ("sebi", "sebi"), ("eu_ai_act", "eu_ai_act"))))
    ref = F.coalesce(F.nullif(F.col("reference"), F.lit("")), found(F.col("title")), F.when(F.col("kind") == "sebi", found(F.col("date_text"))), F.when(F.col("kind") == "eu_ai_act", found(F.col("summary"))))
    types = F.create_map(*(F.lit(v) for pair in ENTRY_TYPES.items() for v in pair))
    about = F.struct(ref.alias("reference_number"), F.try_element_at(types, F.col("kind")).alias("document_type"), F.nullif(F.col("department"), F.lit("")).alias("department"), F.lit(None).cast("string").alias("feed_id"), F.lit(None).cast("string").alias("fr_citation"), F.lit(None).cast("array<string>").alias("agencies"))
    return x.select(*keep, "position", absolute_url(F.lit(base_url), F.col("href")).alias("url"), "title", metadata.listing_date(F.col("date_text")).alias("published_date"), F.nullif(F.col("summary"), F.lit("")).alias("summary"), about.cast(ENTRY_METADATA).alias("metadata"))


RESULT = "struct<results: array<struct<title: string, html_url: string, pdf_url: string, publication_date: string, type: string, document_number: string, citation: string, abstract: string, agencies: array<struct<name: string>>>>>"


def since(published: Column, cutoff: Column | None) -> Column:
    """Whether an entry passes a cutoff; one without date does."""
    return F.lit(True) if cutoff is None else cutoff.isNull() | published.isNull() | (published >= cutoff)


def entries_from_json(feeds: DataFrame, body: Column, max_items: int = 50, cutoff: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Entries of register answers: the first ``max_items`` of each by position, then those not before the cutoff."""
    x = feeds.select(*keep, F.posexplode(F.slice(F.coalesce(F.from_json(body, RESULT)["results"], F.array().cast("array<struct<title: string, html_url: string, pdf_url: string, publication_date: string, type: string, document_number: string, citation: string, abstract: string, agencies: array<struct<name: string>>>>")), 1, max_items)).alias("position", "r"))
    r = lambda name: F.col(f"r.{name}")
    about = F.struct(r("document_number").alias("reference_number"), F.coalesce(F.upper(F.nullif(r("type"), F.lit(""))), F.lit("REGULATION")).alias("document_type"), F.lit(None).cast("string").alias("department"), F.lit(None).cast("string").alias("feed_id"), r("citation").alias("fr_citation"), F.transform(F.coalesce(r("agencies"), F.array().cast("array<struct<name: string>>")), lambda a: F.coalesce(a["name"], F.lit(""))).alias("agencies"))
    out = x.select(*keep, "position", F.coalesce(F.nullif(r("html_url"), F.lit("")), r("pdf_url")).alias("url"), r("title").alias("title"), metadata.feed_date(r("publication_date")).alias("published_date"), r("abstract").alias("summary"), about.cast(ENTRY_METADATA).alias("metadata"))
    return out.where(since(F.col("published_date"), cutoff))


_RSS = "array<struct<title: string, link: string, description: string, pubDate: string, updated: string, created: string, guid: string>>"
_ATOM = "array<struct<title: string, link: array<struct<_href: string, _rel: string>>, summary: string, content: string, published: string, updated: string, created: string, id: string>>"


def entries_from_rss(feeds: DataFrame, body: Column, max_items: int = 50, cutoff: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Entries of RSS and Atom documents, as ``entries_from_json``; documents that aren't well-formed have none.

    The date is the one of publication, else of the last change, else of creation, whichever can be read first.
    """
    found = F.from_xml(body, f"channel struct<item: {_RSS}>, entry {_ATOM}", {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "true"})
    kinds = "struct<title: string, link: string, description: string, date: string, updated: string, created: string, guid: string>"

    def atom(e: Column) -> Column:
        main = F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
        return F.struct(e["title"], F.get(F.coalesce(F.nullif(main, F.array().cast("array<struct<_href: string, _rel: string>>")), e["link"]), F.lit(0))["_href"], F.coalesce(e["summary"], e["content"]), e["published"], e["updated"], e["created"], e["id"]).cast(kinds)

    rss = F.transform(found["channel"]["item"], lambda e: F.struct(e["title"], e["link"], e["description"], e["pubDate"], e["updated"], e["created"], e["guid"]).cast(kinds))
    parsed = F.coalesce(rss, F.transform(found["entry"], atom), F.array().cast(f"array<{kinds}>"))
    x = feeds.select(*keep, F.posexplode(F.slice(parsed, 1, max_items)).alias("position", "r"))
    r = lambda name: F.col(f"r.{name}")
    about = F.struct(metadata.listing_reference(r("title"), "fda").alias("reference_number"), F.lit("PRESS_RELEASE").alias("document_type"), F.lit(None).cast("string").alias("department"), r("guid").alias("feed_id"), F.lit(None).cast("string").alias("fr_citation"), F.lit(None).cast("array<string>").alias("agencies"))
    out = x.select(*keep, "position", F.coalesce(r("link"), F.lit("")).alias("url"), F.coalesce(r("title"), F.lit("")).alias("title"), metadata.feed_date(r("date"), r("updated"), r("created")).alias("published_date"), F.coalesce(r("description"), F.lit("")).alias("summary"), about.cast(ENTRY_METADATA).alias("metadata"))
    return out.where(since(F.col("published_date"), cutoff))
