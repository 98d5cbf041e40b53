"""Problem 3: lines repeated across the documents of one source, found through bitmaps of documents.

Each document gets a place (source, bucket, offset): its bucket is a hash of its id, its offset the rank
of the id inside source and bucket, so places are dense and the same however often a task runs. A line's
documents in a bucket are a word-aligned compressed bitmap: one 64-bit word for each 64 offsets, words of
zeros are not stored. Spellings of a line that differ only in case, digits, punctuation, symbols and
white space have one key, and ``bit_or`` unites their bitmaps. Cardinalities are sums of ``bit_count``,
hence exact. The bitmaps of lines above the threshold are read back: the bits that are set name the documents that
have the line, and of those documents, and no others, the lines with the key are looked up.

All steps but the sum of cardinalities stay inside (source, bucket), so a source that holds a third of
all rows is spread over its buckets; the sum is pre-aggregated before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.io import materialise

LEAST_DOCUMENTS = 5
#: Documents of one bucket over all sources, about.
BUCKET_DOCUMENTS = 8192


def line_key(line: Column) -> Column:
    """64-bit key of a line's letters and marks in lower case; null if there are none."""
    bare = F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}]+", "")
    return F.when(bare != "", F.xxhash64(bare))


def placed(docs: DataFrame, source_col: str, id_col: str, text_col: str, rows: int | None = None) -> DataFrame:
    """(source, bucket, id, offset, keys): a document once, with the key of each of its lines in order."""
    buckets = max(1, -(-(docs.count() if rows is None else rows) // BUCKET_DOCUMENTS))
    keys = F.transform(F.split(F.col(text_col), "\n", -1), line_key)
    slim = docs.where(F.col(text_col).isNotNull() & F.col(source_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(source_col).alias("source"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int").alias("bucket"), F.col(id_col).alias("id"), keys.alias("keys")
    )
    once = slim.repartition("source", "bucket").groupBy("source", "bucket", "id").agg(F.first("keys").alias("keys"))
    return once.withColumn("offset", F.expr("row_number() OVER (PARTITION BY source, bucket ORDER BY id) - 1"))


def occurrences(places: DataFrame) -> DataFrame:
    """(source, bucket, key, word, bit) of each line that has a key."""
    lines = places.select("source", "bucket", "offset", F.explode("keys").alias("key")).where(F.col("key").isNotNull())
    return lines.select("source", "bucket", "key", F.expr("offset div 64").alias("word"), F.expr("cast(offset % 64 as int)").alias("bit"))


def line_bitmaps(lines: DataFrame) -> DataFrame:
    """(source, bucket, key, word, bits): the stored words of each line's bitmap."""
    return lines.groupBy("source", "bucket", "key", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def repeated_lines(docs: DataFrame, source_col: str = "source_id", id_col: str = "doc_id", text_col: str = "clean_text", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(id, line_no) of every line that stands in at least ``least`` different documents of its source.

    Lines are what lies between ``\\n``, from 1. Null texts, sources and ids have no case, an empty text
    neither; a document delivered twice counts once. Lines without a letter are no case. Other columns
    are left out; an empty table gives an empty result.
    """
    places = materialise(placed(docs, source_col, id_col, text_col), "places")
    words = line_bitmaps(occurrences(places))
    many = words.groupBy("source", "key").agg(F.sum(F.bit_count("bits")).alias("documents")).where(F.col("documents") >= least).select("source", "key")
    kept = words.join(many, ["source", "key"], "left_semi")
    # every set bit is a document: its offset, and by it the document, without a second pass over all lines
    bits = F.expr("transform(filter(sequence(0, 63), b -> getbit(bits, b) = 1), b -> cast(word * 64 + b AS int))")
    where = kept.select("source", "bucket", "key", F.explode(bits).alias("offset"))
    gone = where.groupBy("source", "bucket", "offset").agg(F.collect_set("key").alias("gone"))
    lines = places.join(gone, ["source", "bucket", "offset"]).select("id", "gone", F.posexplode("keys").alias("at", "key"))
    return lines.where(F.array_contains("gone", F.col("key"))).select(F.col("id").alias(id_col), (F.col("at") + 1).alias("line_no"))


def without_lines(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "clean_text") -> DataFrame:
    """(id, text) of each document without the found lines; a null text stays null."""
    drop = found.groupBy(id_col).agg(F.collect_set("line_no").alias("__drop"))
    x = docs.select(id_col, text_col).dropDuplicates([id_col]).join(drop, id_col, "left")
    kept = F.filter(F.split(text_col, "\n", -1), lambda line, i: ~F.array_contains(F.col("__drop"), i + 1))
    return x.select(id_col, F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(text_col))
