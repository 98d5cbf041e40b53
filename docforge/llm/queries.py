"""The pN_ queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.functions.text import SPACE
from docforge.io import table
from docforge.llm import garbled, history, languages, packing, page_body, repetition, scans, site_lines, tokens


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return page_body.boilerplate_lines(table(spark, d, "parsed_documents"), table(spark, d, "raw_documents"))


def p1_body(spark: SparkSession, d: str) -> DataFrame:
    return page_body.main_bodies(table(spark, d, "parsed_documents"), table(spark, d, "raw_documents"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return history.near_duplicates(table(spark, d, "document_records"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.repeated_lines(table(spark, d, "document_records"))


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "document_records")
    return site_lines.without_lines(records, site_lines.repeated_lines(records))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    raw = garbled.garbled_pages(table(spark, d, "raw_documents")).select(F.lit("raw").alias("kind"), F.col("raw_id").cast("string").alias("row_key"))
    records = garbled.garbled_records(table(spark, d, "document_records")).select(F.lit("record").alias("kind"), F.col("doc_id").alias("row_key"))
    return raw.unionByName(records)


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    raw = garbled.restored_pages(table(spark, d, "raw_documents")).select(F.lit("raw").alias("kind"), F.col("raw_id").cast("string").alias("row_key"), "text", "restored")
    records = garbled.restored_records(table(spark, d, "document_records")).select(F.lit("record").alias("kind"), F.col("doc_id").alias("row_key"), F.col("clean_text").alias("text"), "restored")
    return raw.unionByName(records)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.faults(table(spark, d, "parsed_documents"))


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired(table(spark, d, "parsed_documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.wrong_labels(p7_languages(spark, d))


def p7_languages(spark: SparkSession, d: str) -> DataFrame:
    return languages.languages(table(spark, d, "document_records"), languages.fit(table(spark, d, "language_samples")))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(table(spark, d, "documents"))


#: A container of p9_fill holds at most an item for each so many tokens of its capacity.
TOKENS_A_SEGMENT = 32


def _p9_specs(spark: SparkSession, d: str) -> DataFrame:
    segments = F.greatest(F.lit(1), F.expr(f"capacity_tokens div {TOKENS_A_SEGMENT}"))
    return table(spark, d, "container_specs").withColumns({"segments": segments, "loss_capacity": F.col("capacity_tokens")})


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """A text up to its first line break is its prompt and bears no loss; a text of one line bears loss on all tokens."""
    prompt = F.instr("text", "\n")
    docs = table(spark, d, "documents").withColumn("loss_share", 1 - prompt / F.greatest(F.length("text"), F.lit(1)))
    return packing.fill(docs, _p9_specs(spark, d), loss_col="loss_share")


def p9_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p9_fill(spark, d), _p9_specs(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repeated_texts(table(spark, d, "documents"))


def p10_share(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_body, p2_found, p3_found, p3_clean, p4_found, p4_restored, p5_found, p5_repaired, p7_found, p7_languages, p8_ids, p9_fill, p9_usage, p10_found, p10_share)}


_WS = SPACE
_REPEATED = f"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[\\p{{P}}\\p{{Nd}}\\p{{Cf}}]+', '', 'g'), '{_WS}'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, len(w) AS n, i, array_to_string(w[i:i + 9], ' ') AS run FROM t, LATERAL (SELECT unnest(range(1, len(w) - 8)) AS i) WHERE len(w) >= 10),
a AS (SELECT doc_id, n, i, min(i) OVER (PARTITION BY doc_id, run) AS f FROM r),
c AS (SELECT doc_id, n, count(DISTINCT i + k) AS rep FROM a, range(10) t(k) WHERE i > f GROUP BY doc_id, n)"""
SQL = {
    "p3_found": """WITH r AS (SELECT DISTINCT source_id, doc_id, clean_text FROM document_records WHERE clean_text IS NOT NULL AND source_id IS NOT NULL),
l AS (SELECT source_id, doc_id, i::INT AS line_no, regexp_replace(lower(x[i]), '[^\\p{L}\\p{M}]+', '', 'g') AS k FROM (SELECT *, string_split(clean_text, chr(10)) AS x FROM r), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i)),
m AS (SELECT source_id, k FROM l WHERE k <> '' GROUP BY source_id, k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, line_no FROM l JOIN m USING (source_id, k)""",
    "p3_clean": """WITH r AS (SELECT DISTINCT source_id, doc_id, clean_text FROM document_records),
l AS (SELECT source_id, doc_id, i::INT AS line_no, regexp_replace(lower(x[i]), '[^\\p{L}\\p{M}]+', '', 'g') AS k, x[i] AS line FROM (SELECT *, string_split(clean_text, chr(10)) AS x FROM r WHERE clean_text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i)),
m AS (SELECT source_id, k FROM l WHERE k <> '' AND source_id IS NOT NULL GROUP BY source_id, k HAVING count(DISTINCT doc_id) >= 5),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS kept FROM l LEFT JOIN m USING (source_id, k) WHERE m.k IS NULL GROUP BY doc_id)
SELECT r.doc_id, CASE WHEN r.clean_text IS NULL THEN NULL ELSE coalesce(t.kept, '') END AS clean_text FROM (SELECT DISTINCT doc_id, clean_text FROM r) r LEFT JOIN t USING (doc_id)""",
    "p10_found": f"""{_REPEATED}
SELECT doc_id FROM c WHERE rep >= 0.3 * n""",
    "p10_share": f"""{_REPEATED}
SELECT d.doc_id, coalesce(c.rep, 0)::BIGINT AS repeated_words, coalesce(len(t.w), 0)::BIGINT AS words, coalesce(c.rep, 0) / greatest(coalesce(len(t.w), 0), 1)::DOUBLE AS repeated_share
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    """Queries without SQL are tested against brute force, a reference tokenizer or an exact round trip."""
    return dict(SQL)
