"""Record types as Spark schemas (DDL), and the values that closed text columns may hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Members of the closed sets.
JURISDICTIONS = "RBI", "SEBI", "FDA", "EU_AI_ACT"
DOCUMENT_TYPES = "NOTIFICATION", "PRESS_RELEASE", "CIRCULAR", "RSS_ITEM", "REGULATION", "NEWS"

SOURCE = "id string not null, jurisdiction string not null, name string not null, listing_url string, feed_url string, adapter string not null, crawl_policy map<string,int>"
ENTRY_METADATA = "struct<reference_number: string, document_type: string, department: string, feed_id: string, fr_citation: string, agencies: array<string>>"
REMOTE_ENTRY = f"url string, title string, published_date timestamp, summary string, metadata {ENTRY_METADATA}"
FETCH_RESULT = "url string, status int, content binary, headers map<string,string>, etag string, last_modified string, from_cache boolean"
RAW_DOCUMENT = "source_id string, url string, fetched_at timestamp, http_status int, content_bytes binary, headers map<string,string>, etag string, last_modified string"
PARSED_DOCUMENT = "doc_id string, url string, title string, body_text string, published_date timestamp, reference_number string, document_type string, lang string"
NORMALIZED_DOCUMENT = f"{PARSED_DOCUMENT}, clean_text string, language string, char_count int, word_count int"
DOCUMENT_CHUNK = "chunk_id string, doc_id string, ord int, text string, char_count int"
DOCUMENT_RECORD = (
    f"{PARSED_DOCUMENT}, clean_text string, char_count int, word_count int, source_id string, jurisdiction string, content_hash string,"
    " simhash string, embedding_ids array<string>, status string, created_at timestamp_ntz, updated_at timestamp_ntz"
)
AUDIT_EVENT = "event_id string not null, ts timestamp_ntz, stage string, actor string, action string, run_id string, doc_id string, metadata map<string,string>"


def member(value: Column, allowed: tuple[str, ...], what: str) -> Column:
    """The value itself; a query that meets one outside ``allowed`` fails. Nulls pass."""
    return F.when(value.isNull() | value.isin(*allowed), value).otherwise(F.raise_error(F.concat(F.lit(f"unknown {what}: "), value)))
