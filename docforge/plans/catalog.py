"""All queries of the core, by name, and the SQL each is checked against.

A query takes (spark, data folder). ``SQL`` has the same result for an independent engine; queries
without an entry there are tested against brute force on small inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.functions import html, language, metadata, pdf, text
from docforge.io import table
from docforge.operators import analysis, crawl, dedup, ngrams, normalize, parse, search, store, timestamps
from docforge.sources import fetch, listings, registry
from docforge.streaming import state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
# The white space class as the other engine writes it.
_WS = text.SPACE
_WORDS = f"list_filter(regexp_split_to_array(%s, '{_WS}'), lambda w: w <> '')"
CUTOFF = "2020-01-01 00:00:00"


def query(sql: str | None = None):
    """Register a query, with the SQL it is checked against."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Text functions


@query(f"""SELECT lang, count(*) AS docs, sum(coalesce(len({_WORDS % "text"}), 0))::BIGINT AS words, sum(coalesce(length(text), 0))::BIGINT AS chars,
count(DISTINCT coalesce(sha256(text), ''))::BIGINT AS different FROM documents GROUP BY lang""")
def doc_token_stats(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("lang", text.word_count(F.col("text")).alias("w"), text.char_count(F.col("text")).alias("c"), text.content_hash(F.col("text")).alias("h"))
    return x.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(F.coalesce("w", F.lit(0))).alias("words"), F.sum(F.coalesce("c", F.lit(0))).alias("chars"), F.count_distinct("h").alias("different"))


@query("""SELECT regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)), '^www\\.', '') AS site, count(DISTINCT doc_id) AS docs FROM parsed_documents GROUP BY 1""")
def site_key_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed_documents").groupBy(text.site_key(F.col("url")).alias("site")).agg(F.count_distinct("doc_id").alias("docs"))


@query("""SELECT DISTINCT raw_id, substr(sha256(url || '|' || strftime(timezone('UTC', fetched_at), '%Y-%m-%dT%H:%M:%S') || '+00:00'), 1, 16) AS doc_id FROM raw_documents""")
def doc_id_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_documents").select("raw_id", text.document_id(F.col("url"), F.col("fetched_at")).alias("doc_id")).distinct()


@query("""WITH r AS (SELECT DISTINCT raw_id, http_status, substr(sha256(url || '|' || strftime(timezone('UTC', fetched_at), '%Y-%m-%dT%H:%M:%S') || '+00:00'), 1, 16) AS doc_id FROM raw_documents),
p AS (SELECT DISTINCT doc_id, lang FROM parsed_documents)
SELECT http_status, count(*) AS pages, count(p.doc_id) AS parsed FROM r LEFT JOIN p USING (doc_id) GROUP BY http_status""")
def raw_parsed_link(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_documents").select("raw_id", "http_status", text.document_id(F.col("url"), F.col("fetched_at")).alias("doc_id")).distinct()
    p = table(spark, d, "parsed_documents").select("doc_id", F.lit(1).alias("hit")).distinct()
    return r.join(p, "doc_id", "left").groupBy("http_status").agg(F.count("*").alias("pages"), F.count("hit").alias("parsed"))


@query("SELECT DISTINCT doc_id, title FROM documents")
def mojibake_repair(spark: SparkSession, d: str) -> DataFrame:
    """Titles read once as Latin-1 come back."""
    bad = F.decode(F.encode("title", "UTF-8"), "ISO-8859-1")
    return table(spark, d, "documents").select("doc_id", text.repair_encoding(bad).alias("title")).distinct()


@query("""SELECT entry_id, url, CASE WHEN url LIKE 'http%' THEN 'https://a.example' || regexp_extract(url, '^[a-z]+://[^/]+(.*)$', 1) END AS rooted FROM (SELECT DISTINCT entry_id, url FROM remote_entries)""")
def absolute_urls(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "remote_entries").select("entry_id", "url").distinct()
    rooted = text.absolute_url(F.lit("https://a.example/x/y"), F.regexp_extract("url", "^[a-z]+://[^/]+(.*)$", 1))
    return x.select("entry_id", text.absolute_url(F.lit("https://b.example/"), F.col("url")).alias("url"), rooted.alias("rooted"))


# What counts for each language, written out for the other engine: lists of words, and of patterns of characters.
_SQL_WORDS = {
    "en": (("the", "and", "or", "of", "to", "a", "in", "is", "that", "for", "on", "with", "as", "by", "at", "from"), ("this", "that", "have", "has", "had", "will", "would", "could", "should", "may", "might", "must")),
    "de": (("der", "die", "das", "und", "oder", "in", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "so", "mehr"),),
}
_SQL_MARKS = {"hi": ("[\u0900-\u097f]", "[\u0964\u0965]"), "mr": ("[\u0900-\u097f\u3002]", "\u0965"), "ru": ("[\u0400-\u04ff.!?]",)}


def _language_sql() -> str:
    parts = []
    for n, lang in enumerate(language.ORDER):
        if lang in language.WORDS:
            lists = _SQL_WORDS.get(lang) or (tuple(language.WORDS[lang].split()),)
            score = " + ".join(f"len(list_filter(k, lambda w: w IN {tuple(x)}))" for x in lists)
        else:
            patterns = _SQL_MARKS.get(lang) or (language.CHARACTERS[lang].replace("'", "''"),)
            score = " + ".join(f"len(regexp_extract_all(text, '{x}'))" for x in patterns)
        parts.append(f"struct_pack(s := ({score})::BIGINT, o := {-n}, l := '{lang}')")
    return f"""WITH t AS (SELECT doc_id, lang, text, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+') AS k FROM documents),
b AS (SELECT doc_id, lang, text, list_max([{", ".join(parts)}]) AS m FROM t),
r AS (SELECT doc_id, lang, CASE WHEN coalesce(length(trim(text)), 0) < 20 OR m.s = 0 THEN 'en' ELSE m.l END AS language,
round(CASE WHEN coalesce(length(trim(text)), 0) < 20 OR m.s = 0 THEN 0.1 ELSE least(m.s / (length(text) / 100.0), 1.0) END, 6)::DOUBLE AS confidence FROM b)"""


@query(_language_sql() + " SELECT doc_id, language, confidence FROM r")
def doc_language_heuristic(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", language.detect(F.col("text")).alias("x"))
    return x.select("doc_id", "x.language", F.round("x.confidence", 6).alias("confidence"))


@query(_language_sql() + " SELECT lang, language, count(*) AS docs FROM r GROUP BY lang, language")
def language_confusion(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("lang", language.detect(F.col("text")).alias("x"))
    return x.groupBy("lang", F.col("x.language").alias("language")).agg(F.count("*").alias("docs"))


# Metadata

_RECORD_TEXT = "concat_ws(chr(10), title, clean_text)"


def _records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "document_records").select("doc_id", "jurisdiction", "url", F.concat_ws("\n", "title", "clean_text").alias("t")).distinct()


def _case(make: Callable[[str], str]) -> str:
    return "CASE jurisdiction " + " ".join(f"WHEN '{j}' THEN {make(j)}" for j in metadata.DATES) + " END"


def _date_sql(j: str) -> str:
    forms = {"d MMM yyyy": "%d %b %Y", "dd/MM/yyyy": "%d/%m/%Y", "MM/dd/yyyy": "%m/%d/%Y", "yyyy-MM-dd": "%Y-%m-%d", "MMMM d, yyyy": "%B %d, %Y", "d MMMM yyyy": "%d %B %Y"}
    one = lambda p, f: f"list_filter(list_transform(regexp_extract_all(h, '{p}', 1), lambda x: try_strptime(regexp_replace(x, '\\s+', ' ', 'g'), '{forms[f]}')), lambda x: x IS NOT NULL)[1]"
    return "coalesce(" + ", ".join(one(p, f) for p, f in metadata.DATES[j]) + ")"


def _first_sql(col: str, patterns: tuple[str, ...]) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({col}, '{p}', 1), '')" for p in patterns) + ", NULL)"


def _type_sql(j: str) -> str:
    default = metadata.FALLBACK_TYPES[j]
    return "CASE " + " ".join(f"WHEN regexp_matches(lower(concat_ws(' ', h, url)), '{p}') THEN '{t}'" for t, p in metadata.TYPES[j]) + f" ELSE {'NULL' if default is None else repr(default)} END"


_HEADS = f"WITH t AS (SELECT DISTINCT doc_id, jurisdiction, url, substr({_RECORD_TEXT}, 1, {metadata.HEAD_CHARS}) AS h FROM document_records) "


@query(_HEADS + f"SELECT doc_id, {_case(_date_sql)} AS published FROM t")
def metadata_date_first_valid(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).select("doc_id", metadata.published_date(F.col("t"), F.col("jurisdiction")).cast("timestamp_ntz").alias("published"))


@query(_HEADS + f"SELECT doc_id, coalesce({_case(lambda j: _first_sql('h', metadata.REFERENCES[j]))}, {_first_sql('url', metadata.URL_REFERENCES)}) AS reference FROM t")
def metadata_reference(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).select("doc_id", metadata.reference_number(F.col("t"), F.col("url"), F.col("jurisdiction")).alias("reference"))


@query(_HEADS + f"SELECT doc_id, {_case(_type_sql)} AS kind FROM t")
def document_type_cascade(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).select("doc_id", metadata.document_type(F.col("t"), F.col("url"), F.col("jurisdiction")).alias("kind"))


@query("""SELECT DISTINCT doc_id, reference_number, nullif(regexp_extract('see ' || coalesce(reference_number, ''), '\\b([A-Z]{2,}\\.\\w+(?:\\.\\w+)*/\\d+(?:\\.\\d+)*(?:/\\d{2,4}(?:-\\d{2,4})?)?)\\b', 1), '') AS rbi,
nullif(regexp_extract('see ' || coalesce(reference_number, ''), '(?i)\\b(Article\\s+\\d+[A-Z]?|Annex\\s+[IVX]+|Recital\\s+\\d+)\\b', 1), '') AS eu FROM document_records""")
def listing_references(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.lit("see "), F.coalesce("reference_number", F.lit("")))
    return table(spark, d, "document_records").select("doc_id", "reference_number", metadata.listing_reference(said, "rbi").alias("rbi"), metadata.listing_reference(said, "eu_ai_act").alias("eu")).distinct()


@query("""SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP AS listed, date_trunc('day', o_orderdate)::TIMESTAMP AS feed FROM orders""")
def listing_and_feed_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of orders written as a listing and a feed would, and read back."""
    x = table(spark, d, "orders").withColumn("day", F.date_trunc("day", "o_orderdate"))
    listed = metadata.listing_date(F.concat(F.lit("On "), F.date_format("day", "d MMMM yyyy"), F.lit(" issued")))
    fed = metadata.feed_date(F.lit("soon"), F.concat(F.date_format("day", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT")))
    zone = F.current_timezone()
    return x.select("o_orderkey", listed.cast("timestamp_ntz").alias("listed"), F.to_utc_timestamp(fed, zone).cast("timestamp_ntz").alias("feed"))


# Sources and crawl


@query("""SELECT id, adapter FROM sources WHERE adapter IN ('rbi', 'sebi') AND jurisdiction IN ('RBI', 'SEBI')""")
def source_allowlist(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources")
    picked = registry.allowed(s, [], ["rbi", "sebi"])
    return registry.by_jurisdiction(picked, "RBI").unionByName(registry.by_jurisdiction(picked, "SEBI")).select("id", "adapter")


@query("""WITH s AS (SELECT id, adapter, listing_url, coalesce(crawl_policy['max_pages'], CASE WHEN adapter = 'sebi' THEN 5 ELSE 3 END) AS most FROM sources WHERE listing_url IS NOT NULL)
SELECT id AS source_id, adapter, n::INT AS page, CASE WHEN n = 1 THEN listing_url WHEN adapter = 'eu_ai_act' THEN listing_url || 'page/' || n || '/' ELSE listing_url || '?page=' || n END AS page_url
FROM s, LATERAL (SELECT unnest(range(1, most + 1)) AS n)""")
def listing_page_urls(spark: SparkSession, d: str) -> DataFrame:
    return registry.listing_pages(table(spark, d, "sources"))


@query("""SELECT id, CASE WHEN lower(feed_url) LIKE '%rss%' OR lower(feed_url) LIKE '%xml%' THEN 'rss' WHEN lower(feed_url) LIKE '%federalregister%' OR lower(feed_url) LIKE '%api%' THEN 'json' END AS feed FROM sources""")
def feed_routing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").select("id", registry.feed_kind(F.col("feed_url")).alias("feed"))


@query("""SELECT jurisdiction, count(DISTINCT raw_id) AS pages FROM raw_documents r JOIN sources s ON r.source_id = s.id GROUP BY jurisdiction""")
def pages_by_jurisdiction(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"), "jurisdiction")
    return table(spark, d, "raw_documents").select("raw_id", "source_id").join(s, "source_id").groupBy("jurisdiction").agg(F.count_distinct("raw_id").alias("pages"))


@query("""SELECT source_id, url, entry_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id, url ORDER BY listed_at, entry_id) AS n FROM remote_entries) WHERE n = 1""")
def url_seen_dedup(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "remote_entries").select("source_id", "url", "entry_id", "listed_at")
    return crawl.first_seen(x, ["listed_at", "entry_id"]).select("source_id", "url", "entry_id")


@query("""SELECT DISTINCT entry_id FROM remote_entries e WHERE NOT EXISTS (SELECT 1 FROM raw_documents r WHERE r.source_id = e.source_id AND r.url = e.url)""")
def url_history_anti(spark: SparkSession, d: str) -> DataFrame:
    return crawl.unseen(table(spark, d, "remote_entries").select("entry_id", "source_id", "url"), table(spark, d, "raw_documents")).select("entry_id").distinct()


@query(f"""SELECT DISTINCT doc_id, published_date FROM document_records WHERE published_date IS NULL OR published_date >= TIMESTAMP '{CUTOFF}'""")
def since_cutoff_null_safe(spark: SparkSession, d: str) -> DataFrame:
    return crawl.not_before(table(spark, d, "document_records").select("doc_id", "published_date"), F.lit(CUTOFF).cast("timestamp_ntz")).distinct()


@query(f"""WITH x AS (SELECT DISTINCT doc_id, source_id, published_date, created_at FROM document_records), n AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY created_at, doc_id) AS n FROM x)
SELECT doc_id, source_id FROM n WHERE n <= 50 AND (published_date IS NULL OR published_date >= TIMESTAMP '{CUTOFF}')""")
def feed_limit_then_since(spark: SparkSession, d: str) -> DataFrame:
    """The first items of a feed, then the cutoff: the limit is the feature."""
    x = table(spark, d, "document_records").select("doc_id", "source_id", "published_date", "created_at").distinct()
    first = crawl.first_items(x, 50, ["source_id"], ["created_at", "doc_id"])
    return crawl.not_before(first, F.lit(CUTOFF).cast("timestamp_ntz")).select("doc_id", "source_id")


@query("""SELECT http_status, CASE WHEN http_status BETWEEN 200 AND 299 THEN 'fetched' WHEN http_status = 304 THEN 'skipped' ELSE 'error' END AS outcome, count(DISTINCT raw_id) AS pages FROM raw_documents GROUP BY 1, 2""")
def fetch_status_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_documents").groupBy("http_status", fetch.outcome(F.col("http_status")).alias("outcome")).agg(F.count_distinct("raw_id").alias("pages"))


@query("""WITH r AS (SELECT DISTINCT raw_id, source_id, url, http_status, fetched_at FROM raw_documents)
SELECT source_id, count(DISTINCT url) AS entries_found, count(*) FILTER (http_status BETWEEN 200 AND 299) AS entries_fetched, count(*) FILTER (http_status = 304) AS entries_skipped,
count(*) FILTER (NOT (http_status BETWEEN 200 AND 299) AND http_status <> 304) AS errors, epoch_us(max(fetched_at)) - epoch_us(min(fetched_at)) AS duration_us FROM r GROUP BY source_id""")
def crawl_stats_by_source(spark: SparkSession, d: str) -> DataFrame:
    return crawl.crawl_stats(table(spark, d, "raw_documents").select("raw_id", "source_id", "url", "http_status", "fetched_at").distinct())


@query("""WITH r AS (SELECT DISTINCT raw_id, source_id, http_status FROM raw_documents)
SELECT source_id, count(*) AS total, count(*) FILTER (http_status = 200) AS ok, count(*) FILTER (http_status <> 200) AS failed,
array_to_string(list_sort(list(DISTINCT 'status ' || http_status) FILTER (http_status <> 200)), ',') AS errors FROM r GROUP BY source_id""")
def batch_stats_with_errors(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_documents").select("raw_id", "source_id", "http_status").distinct()
    x = crawl.batch_stats(r, F.col("http_status") == 200, F.concat(F.lit("status "), F.col("http_status").cast("string")), ["source_id"])
    return x.withColumn("errors", F.when(F.size("errors") > 0, F.array_join("errors", ",")))


@query("""WITH r AS (SELECT DISTINCT raw_id, content_bytes AS c, lower(coalesce(list_filter(map_entries(headers), lambda e: lower(e.key) = 'content-type')[1].value, '')) AS h FROM raw_documents),
s AS (SELECT raw_id, h, lower(coalesce(c[1:100]::VARCHAR, '')) AS head FROM r)
SELECT raw_id, CASE WHEN h LIKE '%pdf%' THEN 'pdf' WHEN regexp_matches(h, 'html|xml|rss|atom') THEN 'html' WHEN head LIKE '\\%pdf%' ESCAPE '\\' THEN 'pdf'
WHEN head LIKE '<!doctype html%' OR head LIKE '<html%' OR head LIKE '<?xml%' OR head LIKE '%<rss%' OR head LIKE '%<feed%' OR head LIKE '%xmlns=%' THEN 'html' ELSE 'unknown' END AS kind FROM s""")
def content_type_sniff(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_documents").dropDuplicates(["raw_id"]).select("raw_id", crawl.content_type(F.col("headers"), F.col("content_bytes")).alias("kind"))


@query()
def html_title_body(spark: SparkSession, d: str) -> DataFrame:
    """Title and body of every fetched page, by document tree."""
    return html.parse_pages(table(spark, d, "raw_documents").where(F.col("http_status") == 200).select("raw_id", "url", "content_bytes"), "raw_id")


# Small pages, and the title and body that come of them.
_LONG = "The depositary shall file its annual report with the desk in charge."
_PAGES = (
    (f"<html><head><title> Named </title></head><body><nav>Menu</nav><p>Before.</p><main><h1>Head</h1><p>{_LONG}</p></main><footer>End</footer></body></html>", "Named", f"Head {_LONG}"),
    ("<html><head><title>Short</title></head><body><nav>Menu</nav><p>Before.</p><main><p>Too short.</p></main><footer>End</footer></body></html>", "Short", "Before. Too short."),
    ("<html><body><script>var x = 1;</script><style>p{}</style><h1>First <i>head</i></h1><p>Text &amp; more.</p></body></html>", "First head", "First head Text & more."),
    ('<html><head><meta property="og:title" content="Shared"></head><body><h2>Second</h2><p>Text.</p></body></html>', "Shared", "Second Text."),
    ("<html><body><h3>Third</h3><p>a\n  b</p></body></html>", "Third", "Third a b"),
    ("<html><body><p>Grüße aus <b>Köln</b></p></body></html>", "A Notice", "Grüße aus Köln"),
)


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}', '{b}')" for i, (_, t, b) in enumerate(_PAGES)) + ") v(raw_id, title, body_text)")
def html_cases(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose title and body are known."""
    x = spark.createDataFrame([(i, "https://a.example/x/a-notice", bytearray(h.encode())) for i, (h, _, _) in enumerate(_PAGES)], "raw_id int, url string, content_bytes binary")
    return html.parse_pages(x, "raw_id").select("raw_id", "title", "body_text")


@query("""SELECT doc_id, 'Notice ' || doc_id AS text, 1 AS page_count, false AS is_scanned FROM documents""")
def pdf_text(spark: SparkSession, d: str) -> DataFrame:
    """Small PDF files made of the documents' ids, and read back."""
    file = F.concat(F.lit("%PDF-1.4\n1 0 obj\n<</Type /Page /Contents 2 0 R>>\nendobj\n2 0 obj\n<< >>\nstream\nBT (Notice ) Tj ("), F.col("doc_id").cast("string"), F.lit(") Tj ET\nendstream\nendobj\n%%EOF"))
    x = table(spark, d, "documents").select("doc_id", F.encode(file, "UTF-8").alias("content_bytes"))
    return pdf.parse_pdfs(x, "doc_id").select("doc_id", "text", "page_count", "is_scanned")


@query("""SELECT DISTINCT entry_id, url, title, summary, upper(metadata.document_type) AS document_type, metadata.reference_number AS reference FROM remote_entries""")
def feed_json_entries(spark: SparkSession, d: str) -> DataFrame:
    """Each entry written as a register's answer, and read back."""
    m = lambda n: F.col(f"metadata.{n}")
    one = F.struct("title", F.col("url").alias("html_url"), m("document_type").alias("type"), m("reference_number").alias("document_number"), F.col("summary").alias("abstract"))
    x = table(spark, d, "remote_entries").select("entry_id", F.to_json(F.struct(F.array(one).alias("results"))).alias("body"))
    out = listings.entries_from_json(x, F.col("body"), keep=("entry_id",))
    return out.select("entry_id", "url", "title", "summary", "metadata.document_type", F.col("metadata.reference_number").alias("reference")).distinct()


@query("""SELECT DISTINCT entry_id, url, coalesce(trim(title), '') AS title, coalesce(trim(summary), '') AS summary, 'PRESS_RELEASE' AS document_type, floor(epoch(listed_at))::BIGINT AS published_s FROM remote_entries""")
def feed_xml_entries(spark: SparkSession, d: str) -> DataFrame:
    """Each entry written as an RSS or an Atom document, by the parity of its page, and read back."""
    escape = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    at = F.to_utc_timestamp("listed_at", F.current_timezone())
    rss = F.concat(F.lit("<rss><channel><item><title>"), escape(F.trim("title")), F.lit("</title><link>"), escape(F.col("url")), F.lit("</link><description>"), escape(F.trim("summary")), F.lit("</description><pubDate>"), F.date_format(at, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), escape(F.trim("title")), F.lit('</title><link href="'), escape(F.col("url")), F.lit('"/><summary>'), escape(F.trim("summary")), F.lit("</summary><updated>"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</updated></entry></feed>"))
    x = table(spark, d, "remote_entries").select("entry_id", F.when(F.coalesce(F.col("page"), F.lit(0)) % 2 == 0, rss).otherwise(atom).alias("body"))
    out = listings.entries_from_rss(x, F.col("body"), keep=("entry_id",))
    return out.select("entry_id", "url", "title", "summary", "metadata.document_type", F.unix_seconds("published_date").alias("published_s")).distinct()


@query("""SELECT DISTINCT entry_id, url, '15 January 2024' AS listed, CASE WHEN source_id LIKE 'rbi%' THEN 'NOTIFICATION' WHEN source_id LIKE 'sebi%' THEN 'CIRCULAR' ELSE 'NEWS' END AS document_type FROM remote_entries""")
def listing_html_entries(spark: SparkSession, d: str) -> DataFrame:
    """Each entry written as a listing of its source's kind, and read back."""
    row = F.format_string('<table><tr><td>15 January 2024</td><td><a href="%s">A title</a></td><td>Desk</td></tr></table>', F.col("url"))
    card = F.format_string('<article><h2><a href="%s">A title</a></h2><time>15 January 2024</time></article>', F.col("url"))
    kind = F.when(F.col("source_id").startswith("rbi"), "rbi_notifications").when(F.col("source_id").startswith("sebi"), "sebi").otherwise("eu_ai_act")
    x = table(spark, d, "remote_entries").select("entry_id", kind.alias("kind"), F.when(kind == "eu_ai_act", card).otherwise(row).alias("html"))
    out = listings.entries_from_pages(x, "https://example.org", keep=("entry_id",))
    return out.select("entry_id", "url", F.date_format("published_date", "d MMMM yyyy").alias("listed"), "metadata.document_type").distinct()


@query("""SELECT DISTINCT entry_id FROM remote_entries WHERE NOT regexp_matches(url, '^[a-z]+://[^/]+/files/') OR regexp_matches(url, '^[a-z]+://[^/]+/files/circulars/')""")
def robots_permitted(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "remote_entries").select("entry_id", "url").distinct()
    hosts = x.select(text.site_key(F.col("url")).alias("host")).distinct()
    files = hosts.withColumn("text", F.lit("User-agent: *\nDisallow: /files/\nAllow: /files/circulars/\n"))
    return fetch.permitted(x, fetch.robots_rules(files)).select("entry_id")


@query("""WITH r AS (SELECT url, max(raw_id) AS raw_id FROM raw_documents GROUP BY url), e AS (SELECT DISTINCT url FROM remote_entries), x AS (SELECT e.url, d.http_status, d.etag FROM e LEFT JOIN r USING (url) LEFT JOIN (SELECT DISTINCT raw_id, http_status, etag FROM raw_documents) d USING (raw_id))
SELECT CASE WHEN http_status IS NULL THEN 404 WHEN etag IS NOT NULL AND http_status BETWEEN 200 AND 299 THEN 304 ELSE http_status END::INT AS status, count(*) AS requests FROM x GROUP BY 1""")
def conditional_replay(spark: SparkSession, d: str) -> DataFrame:
    """All listed URLs asked for again with the validator of their last answer."""
    raw = table(spark, d, "raw_documents")
    last = raw.groupBy("url").agg(F.max_by(F.struct("http_status", "content_bytes", "headers", "etag", "last_modified"), "raw_id").alias("r"))
    answers = last.select("url", F.col("r.http_status").alias("status"), F.col("r.content_bytes").alias("content"), "r.headers", "r.etag", F.lit(None).cast("string").alias("last_modified"))
    asked = table(spark, d, "remote_entries").select("url").distinct().join(answers.select("url", "etag"), "url", "left").withColumn("last_modified", F.lit(None).cast("string"))
    return fetch.replay(asked, answers).groupBy("status").agg(F.count("*").alias("requests"))


@query("""WITH c AS (SELECT source_id, http_status::VARCHAR AS s, count(DISTINCT raw_id) AS n FROM raw_documents GROUP BY 1, 2) SELECT source_id, string_agg(s || ':' || n, ',' ORDER BY s) AS counts FROM c GROUP BY source_id""")
def status_counts_by_source(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_documents").select("raw_id", "source_id", "http_status").distinct()
    x = parse.status_counts(r, "source_id", F.col("http_status").cast("string"))
    return x.select("source_id", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias("counts"))


@query()
def parse_raw_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every fetched page to a parsed document, with its metadata."""
    return parse.parsed_documents(table(spark, d, "raw_documents"), table(spark, d, "sources"))


# Normalisation, n-grams


@query("SELECT DISTINCT doc_id, coalesce(nullif(trim(title), ''), 'Untitled') AS title FROM parsed_documents")
def normalized_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of all parsed documents after normalisation; their texts are in ``normalized_all``."""
    p = table(spark, d, "parsed_documents").select("doc_id", "url", "title", "body_text").distinct()
    return normalize.normalized(p).select("doc_id", "title")


@query()
def normalized_all(spark: SparkSession, d: str) -> DataFrame:
    """All parsed documents, whatever their characters, with text, language and counts; SQL can't state encoding repair."""
    p = table(spark, d, "parsed_documents").select("doc_id", "url", "title", "body_text").distinct()
    return normalize.normalized(p).select("doc_id", "title", "site_key", "clean_text", "language", "confidence", "char_count", "word_count", "content_hash")


_NGRAMS = "WITH g AS (SELECT source AS site, doc_id, substr(text, i::INT, 4) AS ngram FROM documents, LATERAL (SELECT unnest(range(1, length(text) - 2)) AS i) WHERE length(text) >= 4), c AS (SELECT site, doc_id, ngram, count(*) AS n FROM g GROUP BY ALL) "


def _ngrams(spark: SparkSession, d: str, mode: str = "occurrence") -> DataFrame:
    return ngrams.totals(table(spark, d, "documents"), "source", "text", mode=mode)


@query(_NGRAMS + "SELECT ngram, sum(n)::BIGINT AS n FROM c GROUP BY ngram ORDER BY n DESC, ngram LIMIT 10")
def ngram_top10(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.top(_ngrams(spark, d))


@query(_NGRAMS + "SELECT site, ngram, sum(n)::BIGINT AS n FROM c GROUP BY site, ngram HAVING sum(n) >= 3")
def ngram_boilerplate_confirmed(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.confirmed(_ngrams(spark, d))


@query(_NGRAMS + ", s AS (SELECT site, ngram, sum(n) AS n FROM c GROUP BY site, ngram) SELECT site, count(*) AS ngrams, count(*) FILTER (n >= 3) AS confirmed FROM s GROUP BY site")
def ngram_site_stats(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.site_stats(_ngrams(spark, d))


@query(_NGRAMS + ", r AS (SELECT doc_id, coalesce(sum(n) OVER (PARTITION BY site, ngram ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c) SELECT doc_id, count(*) AS ngrams, count(*) FILTER (before >= 3) AS known FROM r GROUP BY doc_id")
def ngram_running_confirm(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.running(ngrams.ngrams(table(spark, d, "documents"), "source", "doc_id", "text")).groupBy("id").agg(F.count("*").alias("ngrams"), F.count_if(F.col("before") >= 3).alias("known")).withColumnRenamed("id", "doc_id")


@query(_NGRAMS + f""", known AS (SELECT site, ngram FROM c GROUP BY site, ngram HAVING sum(n) >= {ngrams.LEAST}),
pos AS (SELECT doc_id, source AS site, substr(text, i::INT, 4) AS ngram, i FROM documents, LATERAL (SELECT unnest(range(1, length(text) - 2)) AS i) WHERE length(text) >= {ngrams.LEAST_CHARS} AND source IS NOT NULL),
hidden AS (SELECT DISTINCT doc_id, i + k AS p FROM pos JOIN known USING (site, ngram), range(4) t(k)),
ch AS (SELECT doc_id, p, substr(text, p::INT, 1) AS x FROM documents, LATERAL (SELECT unnest(range(1, length(text) + 1)) AS p) WHERE doc_id IN (SELECT doc_id FROM hidden)),
m AS (SELECT doc_id, trim(regexp_replace(string_agg(CASE WHEN h.p IS NULL THEN x ELSE ' ' END, '' ORDER BY p), '{_WS}', ' ', 'g')) AS text FROM ch LEFT JOIN hidden h USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, coalesce(m.text, d.text) AS text FROM documents d LEFT JOIN m USING (doc_id)""")
def boilerplate_mask(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the n-grams masked that are confirmed in their source."""
    return ngrams.masked(table(spark, d, "documents"), ngrams.confirmed(_ngrams(spark, d)), "source", "doc_id", "text")



# Store

_RECORD_COLS = ("doc_id", "title", "status", "created_at", "updated_at")
_NOW = "2026-01-01 00:00:00"


@query(f"""WITH o AS (SELECT DISTINCT doc_id, title, status, created_at, updated_at FROM document_records WHERE batch_no <= 3), n AS (SELECT DISTINCT doc_id, upper(title) AS title, 'again' AS status FROM document_records WHERE batch_no >= 2)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN n.doc_id IS NOT NULL THEN n.title ELSE o.title END AS title, CASE WHEN n.doc_id IS NOT NULL THEN n.status ELSE o.status END AS status,
CASE WHEN o.doc_id IS NULL THEN TIMESTAMP '{_NOW}' ELSE o.created_at END AS created_at, CASE WHEN n.doc_id IS NULL THEN o.updated_at ELSE TIMESTAMP '{_NOW}' END AS updated_at FROM o FULL JOIN n ON o.doc_id = n.doc_id""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "document_records")
    old = r.where("batch_no <= 3").select(*_RECORD_COLS).distinct()
    new = r.where("batch_no >= 2").select("doc_id", F.upper("title").alias("title"), F.lit("again").alias("status"))
    return store.upsert(old, new, F.lit(_NOW).cast("timestamp_ntz"))


_CHUNKS = "WITH c AS (SELECT doc_id, lang, i::INT AS ord, (i * 700)::INT AS start, substr(text, (i * 700 + 1)::INT, 800) AS text FROM documents, LATERAL (SELECT unnest(range(0, greatest(1, ceil((length(text) - 100) / 700.0)::INT))) AS i) WHERE length(text) > 0) "


@query(_CHUNKS + "SELECT doc_id, ord, start, text, length(text)::INT AS char_count FROM c")
def chunk_overlap(spark: SparkSession, d: str) -> DataFrame:
    return search.chunks(table(spark, d, "documents"), "doc_id", "text")


@query(_CHUNKS + "SELECT doc_id, ord, text FROM c WHERE lang IS DISTINCT FROM 'en' UNION ALL SELECT doc_id, 0, upper(text) FROM documents WHERE lang = 'en' AND text IS NOT NULL")
def chunk_replace(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of English documents replaced by one each."""
    x = table(spark, d, "documents")
    old = search.chunks(x, "doc_id", "text").select("doc_id", "ord", "text")
    changed = x.where("lang = 'en'")
    new = changed.where("text IS NOT NULL").select("doc_id", F.lit(0).alias("ord"), F.upper("text").alias("text"))
    return store.replace_chunks(old, changed, new)


@query(_CHUNKS + ", a AS (SELECT doc_id, count(*) AS chunks, sum(length(text)) AS chars, string_agg(length(text)::VARCHAR, ',' ORDER BY ord) AS sizes FROM c GROUP BY doc_id) SELECT d.doc_id, coalesce(a.chunks, 0)::BIGINT AS chunks, coalesce(a.sizes, '') AS sizes FROM documents d LEFT JOIN a USING (doc_id)")
def chunk_assemble(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents")
    parts = search.chunks(x, "doc_id", "text").select("doc_id", "ord", "char_count")
    whole = store.with_chunks(x.select("doc_id"), parts)
    return whole.select("doc_id", F.size("chunks").cast("bigint").alias("chunks"), F.array_join(F.transform("chunks", lambda c: c["char_count"].cast("string")), ",").alias("sizes"))


@query("""SELECT lower(content_hash) AS content_hash, min_by(doc_id, struct_pack(a := created_at, b := doc_id)) AS doc_id, count(*) AS documents FROM (SELECT DISTINCT doc_id, content_hash, created_at FROM document_records WHERE content_hash IS NOT NULL) GROUP BY 1""")
def hash_lookup(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "document_records").select("doc_id", F.lower("content_hash").alias("content_hash"), "created_at", F.col("content_hash").alias("raw")).distinct()
    return store.by_hash(x)


@query("""SELECT doc_id, jurisdiction, created_at FROM (SELECT DISTINCT doc_id, jurisdiction, created_at FROM document_records WHERE jurisdiction = 'FDA') ORDER BY created_at, doc_id LIMIT 100 OFFSET 20""")
def list_docs_page(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "document_records").select("doc_id", "jurisdiction", "created_at").distinct()
    return store.page(x, ["created_at", "doc_id"], 100, 20, F.col("jurisdiction") == "FDA")


@query("""SELECT event_type, count(*) AS events FROM events GROUP BY event_type""")
def audit_append(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "ts", "event_type")
    cut = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    return store.append_events(e.where(cut), e.where(~cut)).groupBy("event_type").agg(F.count("*").alias("events"))


@query("""SELECT event_id FROM events WHERE event_type = 'click'""")
def audit_append_conflict(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "ts", "event_type")
    return store.conflicts(e, e.where("event_type = 'click'"))


@query("""SELECT event_id, ts FROM events WHERE event_type = 'purchase' ORDER BY ts, event_id LIMIT 100""")
def audit_page_filtered(spark: SparkSession, d: str) -> DataFrame:
    return store.page(table(spark, d, "events").select("event_id", "ts", "event_type"), ["ts", "event_id"], 100, 0, F.col("event_type") == "purchase").select("event_id", "ts")


@query("""SELECT jurisdiction, document_type, count(*) AS docs FROM documents GROUP BY ROLLUP (jurisdiction, document_type)""")
def documents_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").rollup("jurisdiction", "document_type").agg(F.count("*").alias("docs"))


# Fingerprints and search


@query("""SELECT sha256(text) AS hash, min(doc_id) AS first_id, count(*) AS documents FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def exact_dup_groups(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return dedup.exact_groups(x, "doc_id", "hash")


@query("""SELECT d.doc_id, d.doc_id = g.first_id AS kept FROM documents d JOIN (SELECT text, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY text) g USING (text)""")
def exact_dup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash")).where("hash IS NOT NULL")
    return x.join(dedup.exact_groups(x, "doc_id", "hash"), "hash").select("doc_id", (F.col("doc_id") == F.col("first_id")).alias("kept"))


_SIMHASH = f"""WITH w AS (SELECT doc_id, unnest({_WORDS % "lower(text)"}) AS w FROM documents), h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM w),
b AS (SELECT doc_id, i, sum(2 * ((h >> (63 - i)) & 1)::INT - 1) AS s FROM h, range(64) t(i) GROUP BY doc_id, i),
f AS (SELECT doc_id, coalesce(sum(CASE WHEN s > 0 AND i < 32 THEN 1::BIGINT << (31 - i) END), 0)::BIGINT AS hi, coalesce(sum(CASE WHEN s > 0 AND i >= 32 THEN 1::BIGINT << (63 - i) END), 0)::BIGINT AS lo FROM b GROUP BY doc_id) """


@query(_SIMHASH + "SELECT doc_id, hi, lo FROM f")
def simhash_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    x = dedup.simhash(table(spark, d, "documents"), "doc_id", "text").where("simhash IS NOT NULL")
    return x.select("doc_id", F.shiftrightunsigned("simhash", 32).alias("hi"), F.col("simhash").bitwiseAND(F.lit(0xFFFFFFFF)).alias("lo"))


@query(_SIMHASH + ", v AS (SELECT DISTINCT hi, lo FROM f), p AS (SELECT bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) AS distance FROM v a JOIN v b ON (a.hi, a.lo) < (b.hi, b.lo)) SELECT distance::INT AS distance, count(*) AS pairs FROM p WHERE distance <= 3 GROUP BY 1")
def near_dup_distances(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_fingerprints(dedup.simhash(table(spark, d, "documents"), "doc_id", "text")).groupBy("distance").agg(F.count("*").alias("pairs"))


@query()
def near_dup_classes(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_duplicate_classes(table(spark, d, "documents"), "doc_id", "text")


@query("""WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, v.vec_id AS id, list_cosine_similarity(q.e, v.embedding::DOUBLE[]) AS score FROM q JOIN embeddings v ON v.vec_id <> q.query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) SELECT query_id, id, round(score, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 10""")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set against all rows."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    return search.nearest(v, v.where("vec_id % 100 = 0"), "vec_id", "embedding").select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query("SELECT count(*) AS queries, true AS enough FROM embeddings WHERE vec_id % 100 = 0")
def vector_index_recall(spark: SparkSession, d: str) -> DataFrame:
    """Whether the index finds at least 0.9 of what the search of all rows does, for the stated query set."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    asked, model = v.where("vec_id % 100 = 0"), search.centres(v, "vec_id", "embedding")
    exact = search.nearest(v, asked, "vec_id", "embedding").select("query_id", "id")
    found = search.nearest_indexed(search.indexed(v, model, "vec_id", "embedding"), asked, model, "vec_id", "embedding").select("query_id", "id", F.lit(1).alias("hit"))
    return exact.join(found, ["query_id", "id"], "left").agg(F.count_distinct("query_id").alias("queries"), (F.count("hit") >= 0.9 * F.count("*")).alias("enough"))


@query("""WITH q AS (SELECT vec_id AS query_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, v.vec_id AS id, list_cosine_similarity(q.e, v.embedding::DOUBLE[]) AS score FROM q JOIN embeddings v ON v.vec_id <> q.query_id AND v.label = q.label),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s WHERE score >= 0.1) SELECT query_id, id, round(score, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 5""")
def vector_topk_filtered(spark: SparkSession, d: str) -> DataFrame:
    """As vector_topk, within the query's label and above a floor."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    return search.nearest(v, v.where("vec_id % 100 = 0"), "vec_id", "embedding", k=5, least=0.1, same="label").select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query("""SELECT doc_id, round(('0x' || substr(md5('0|' || text), 1, 8))::BIGINT / 2147483648.0 - 1, 6) AS first, round(('0x' || substr(md5('63|' || text), 1, 8))::BIGINT / 2147483648.0 - 1, 6) AS last FROM documents""")
def hash_embedding(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", search.hash_embedding(F.col("text")).alias("v"))
    return x.select("doc_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(63)), 6).alias("last"))


@query("SELECT topic, count(*) AS docs FROM documents, LATERAL (SELECT unnest([" + ", ".join(f"CASE WHEN regexp_matches(lower(coalesce(text, '')), '{p}') THEN '{t}' END" for t, p in analysis.TOPICS.items()) + "]) AS topic) WHERE topic IS NOT NULL GROUP BY topic")
def topic_lexicon(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(analysis.topics(F.col("text"))).alias("topic")).groupBy("topic").agg(F.count("*").alias("docs"))


_SENTENCES = """s AS (SELECT doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?।])[ \\t\\n\\x0b\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') AS x FROM documents),
i AS (SELECT doc_id, i, x[i] AS t FROM s, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i))"""


@query(f"""WITH {_SENTENCES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY len(regexp_extract_all(lower(t), '{"|".join(analysis.TOPICS.values())}')) DESC, i) AS k FROM i)
SELECT doc_id, coalesce(string_agg(trim(t), chr(10) ORDER BY i) FILTER (k <= 3), '') AS sentences FROM documents LEFT JOIN r USING (doc_id) GROUP BY doc_id""")
def key_sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(analysis.key_sentences(F.col("text")), "\n").alias("sentences"))


@query(f"""WITH RECURSIVE {_SENTENCES},
w AS (SELECT doc_id, i, 0 AS ord, length(t) AS n FROM i WHERE i = 1 UNION ALL
SELECT w.doc_id, i.i, CASE WHEN w.n + length(t) + 1 <= {search.CHUNK_CHARS} THEN ord ELSE ord + 1 END, CASE WHEN w.n + length(t) + 1 <= {search.CHUNK_CHARS} THEN w.n + length(t) + 1 ELSE length(t) END FROM w JOIN i ON i.doc_id = w.doc_id AND i.i = w.i + 1)
SELECT doc_id, ord::INT AS ord, string_agg(t, ' ' ORDER BY i) AS text, length(string_agg(t, ' ' ORDER BY i))::INT AS char_count FROM w JOIN i USING (doc_id, i) GROUP BY doc_id, ord""")
def sentence_chunks(spark: SparkSession, d: str) -> DataFrame:
    return search.sentence_chunks(table(spark, d, "documents"), "doc_id", "text")


# Problem 6


@query()
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.published_instants(table(spark, d, "remote_entries"), table(spark, d, "parsed_documents"), table(spark, d, "source_time_rules"))


# Streams


@query("SELECT DISTINCT source_id, url FROM remote_entries")
def stream_seen_urls(spark: SparkSession, d: str) -> DataFrame:
    s = state.read_files(spark, f"{d}/remote_entries.parquet").select("source_id", "url")
    return state.run_to_table(state.first_seen(s, ["source_id", "url"]))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    e = state.read_files(spark, f"{d}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    out = state.run_to_table(state.windowed_counts(e, "ts", ["event_type"]), "update", ["window_start", "event_type"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""WITH m AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM m)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, s""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = state.read_files(spark, f"{d}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    out = state.run_to_table(state.sessions(e, "ts", ["user_id"]), "complete")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query(_NGRAMS + "SELECT site, ngram, sum(n)::BIGINT AS n FROM c GROUP BY site, ngram")
def stream_ngram_documents(spark: SparkSession, d: str) -> DataFrame:
    """The n-gram state of each source's documents, over their whole texts."""
    return state.run_to_table(state.ngram_counts(state.read_files(spark, f"{d}/documents.parquet"), "source", "text"), "update", ["site", "ngram"])


@query("""SELECT url, arg_max(etag, struct_pack(a := fetched_at, b := coalesce(etag, ''), c := coalesce(last_modified, ''))) AS etag FROM raw_documents WHERE etag IS NOT NULL GROUP BY url""")
def stream_validators(spark: SparkSession, d: str) -> DataFrame:
    s = state.read_files(spark, f"{d}/raw_documents.parquet").select("url", "fetched_at", "etag", "last_modified").where("etag IS NOT NULL")
    return state.run_to_table(state.latest_validators(s), "update", ["url"]).select("url", "etag")


@query()
def stream_token_bucket(spark: SparkSession, d: str) -> DataFrame:
    """When each fetch would be let through by its host's bucket."""
    s = state.read_files(spark, f"{d}/raw_documents.parquet").select(text.site_key(F.col("url")).alias("host"), "fetched_at")
    return state.run_to_table(state.token_bucket(s, "host", "fetched_at"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
