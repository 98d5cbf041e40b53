"""From fetched to parsed documents: routed by content, title and body read, metadata found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions import html, metadata, pdf, text
from docforge.operators.crawl import content_type
from docforge.schemas import DOCUMENT_TYPES, member

#: Documents are taken to be in English until normalisation looks at them.
DEFAULT_LANGUAGE = "en"


def last_segment(url: Column) -> Column:
    """What stands after the last slash of a URL; null if nothing does."""
    return F.nullif(F.element_at(F.split(url, "/"), -1), F.lit(""))


def parsed_documents(raw: DataFrame, sources: DataFrame, selectors: tuple[str, ...] = html.STRIP) -> DataFrame:
    """doc_id, source_id, url, kind, title, body_text, published_date, reference_number, document_type, lang and error of successful fetches.

    PDF files go to the PDF reader, all others are read as HTML. The two are apart before Python sees them,
    so each reader gets its own rows only. A file that can't be read has an error and an empty body. A page
    of an unknown source has no date, type and text reference. Pages fetched twice at one time are one.
    """
    ok = raw.where((F.col("http_status") >= 200) & (F.col("http_status") < 300))
    x = ok.select(text.document_id(F.col("url"), F.col("fetched_at")).alias("doc_id"), "source_id", "url", content_type(F.col("headers"), F.col("content_bytes")).alias("kind"), "content_bytes").dropDuplicates(["doc_id"])
    pages = html.parse_pages(x.where("kind <> 'pdf'"), "doc_id", selectors=selectors).select("doc_id", "title", "body_text", F.lit(None).cast("string").alias("error"))
    files = pdf.parse_pdfs(x.where("kind = 'pdf'"), "doc_id").select("doc_id", F.col("title").alias("title"), F.col("text").alias("body_text"), "error")
    facts = x.select("doc_id", "source_id", "url", "kind")
    both = facts.join(pages.unionByName(files), "doc_id").join(sources.select(F.col("id").alias("source_id"), "jurisdiction"), "source_id", "left")
    title = text.default_title(F.coalesce(F.nullif("title", F.lit("")), last_segment(F.col("url"))))
    said = F.concat(title, F.lit("\n"), F.col("body_text"))
    return both.select(
        "doc_id", "source_id", "url", "kind", title.alias("title"), "body_text",
        metadata.published_date(said, F.col("jurisdiction")).alias("published_date"),
        metadata.reference_number(said, F.col("url"), F.col("jurisdiction")).alias("reference_number"),
        member(metadata.document_type(said, F.col("url"), F.col("jurisdiction")), DOCUMENT_TYPES, "document type").alias("document_type"),
        F.lit(DEFAULT_LANGUAGE).alias("lang"), "error",
    )


def status_counts(rows: DataFrame, by: str, status: Column) -> DataFrame:
    """By group, a map from status to rows."""
    each = rows.groupBy(by, status.alias("__s")).agg(F.count("*").alias("__n")).where(F.col("__s").isNotNull())
    return each.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__s", "__n")))).alias("counts"))
